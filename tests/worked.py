"""Small frames beside the rows that were worked out for them by hand."""

from types import SimpleNamespace


class Worked:
    def __init__(self):
        self.cases = {}

    def add(self, name, expected):
        """``expected`` is (columns as "name TYPE, ...", rows)."""

        def wrap(f):
            self.cases[name] = (f, *expected)
            return f

        return wrap

    def check(self, spark, name):
        f, columns, rows = self.cases[name]
        names = [c.split()[0] for c in columns.split(", ")]
        plain = lambda x: None if x is None else float(x) if type(x).__name__ == "Decimal" else str(x) if type(x).__name__ == "date" else x
        order = lambda r: tuple((x is not None, str(x)) for x in r)
        got = sorted((tuple(plain(r[c]) for c in names) for r in f(SimpleNamespace(spark=spark)).collect()), key=order)
        assert got == sorted((tuple(r) for r in rows), key=order)
