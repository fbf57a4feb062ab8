"""Exact repeated byte strings by distributed prefix doubling over sampled positions.

Doubling over every byte position would sort a row a byte in each round.  Here the
positions are a synchronised sample: of the ``q``-byte strings in each window of
``length`` bytes, the one with the smallest hash is the window's anchor.  The choice
reads nothing but the window, so equal windows have their anchors at the same offset,
and about one position in forty is an anchor.

A round ranks groups of neighbouring windows by the string that all of them share, their
core, and tells them apart by the whole that they cover together.  In the first round a
group is all windows of an anchor and its core the anchor's ``q`` bytes; cores then double
to 2q, 4q, ... bytes until they are a window long.  Spark sorts the pairs (rank so far,
core at the grown reach) and numbers them densely; equal pairs have equal ranks.

* A group whose rank is its own is done: none of its windows repeats.
* Groups of one rank and one whole repeat as one; the first stays and all windows of the
  others are removed.
* Firsts of a rank that holds several wholes are split into smaller groups at fixed
  offsets from the anchor, whose cores are twice as long, and ranked again.

The rounds end past the threshold, where a group is one window and its core all of its
bytes.  Strings enter a sort by 64 bits of content, and groups are equal by 128.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytespan import BASE_A, BASE_B, Rolling, U, byte_symbols, mix, pieces, text_bytes
from .grouping import lists_by_document, same_group, starts as group_starts
from ..scratch import Scratch

#: Bytes of text that are anchored at once; longer texts are cut in overlapping blocks.
BLOCK = 1 << 20
_PLACE_BITS = 24


def _blocks(starts: np.ndarray, ends: np.ndarray, overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text numbers, starts, ends) of about BLOCK bytes; blocks of one text overlap by ``overlap`` bytes."""
    for i, j in pieces(starts, ends, BLOCK):
        if j == i + 1 and ends[i] - starts[i] > 4 * BLOCK:
            for at in range(int(starts[i]), int(ends[i]) - overlap, BLOCK):
                yield np.array([i]), np.array([at]), np.array([min(at + BLOCK + overlap, int(ends[i]))])
        else:
            yield np.arange(i, j), starts[i:j], ends[i:j]


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, q: int) -> Iterator[tuple]:
    """(text, rank, whole, first window, windows) of every anchor; places are relative to the text."""
    width = length - q + 1
    for text, s, e in _blocks(starts, ends, length - 1):
        lo, hi = int(s[0]), int(e[-1])
        sym = byte_symbols(data[lo:hi])
        n = len(sym)
        if n < length:
            continue
        near, far = Rolling(sym, BASE_A), Rolling(sym, BASE_B)
        rank = mix(near.windows(q))
        key = (rank & ~U((1 << _PLACE_BITS) - 1)) | np.arange(len(rank), dtype=np.uint64)
        have = 1
        low = key
        while 2 * have <= width:
            low = np.minimum(low[:-have], low[have:])
            have *= 2
        if have < width:
            low = np.minimum(low[: len(key) - width + 1], low[width - have : width - have + len(key) - width + 1])
        ok = np.zeros(n - length + 2, bool)  # windows that stay in a text
        long = e - s >= length
        edge = np.zeros(n - length + 2, np.int32)
        np.add.at(edge, s[long] - lo, 1)
        np.add.at(edge, e[long] - lo - length + 1, -1)
        ok = np.cumsum(edge)[:-1] > 0
        at = np.flatnonzero(ok)
        if not len(at):
            continue
        place = (low[at] & U((1 << _PLACE_BITS) - 1)).astype(np.int64)
        new = np.ones(len(at), bool)
        new[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
        i = np.flatnonzero(new)
        first = at[i]
        count = np.diff(np.append(i, len(at)))
        where = place[i]
        whole = mix(far.spans(first, first + count - 1 + length) + mix(((where - first) * 4096 + count).astype(np.uint64)))
        k = np.searchsorted(s - lo, first, "right") - 1
        base = s[k] - lo - (s[k] - starts[text[k]])
        yield text[k], rank[where], whole, first - base, count, where - base


def _documents(docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """id, v, text; carried columns go along as _c0, _c1, ...

    v tells rows of one id with different texts apart.  It is zero where no id has two
    texts, as it then says nothing and would only widen every row.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("v"), text.alias("text"), *(F.col(c).alias(f"_c{k}") for k, c in enumerate(carry)))
    clash = rows.groupBy("id").agg(F.min("v").alias("a"), F.max("v").alias("b")).filter("a <> b")
    return rows if clash.limit(1).count() else rows.withColumn("v", F.lit(0).cast("long"))


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _taken(b: pa.RecordBatch, t: np.ndarray, names: list[str], *cols: pa.Array) -> pa.RecordBatch:
    take = pa.array(t)
    return pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), *cols], ["id", "v", *names])


def same(a: DataFrame, b: DataFrame, *keys: str) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & a[k].eqNullSafe(b[k])
    return out


def with_spans(documents: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    mine = [documents[c] for c in documents.columns]
    return documents.join(spans, same(documents, spans, "id", "v"), how).select(*mine[:3], *(spans[c] for c in spans.columns if c not in ("id", "v")), *mine[3:])


def span_lists(columns: list[pa.Array]) -> tuple[np.ndarray, list[np.ndarray]]:
    """(row of each entry, its fields) of list columns of equal lengths; null lists are empty."""
    size = np.asarray(columns[0].value_lengths().fill_null(0)).astype(np.int64)
    return np.repeat(np.arange(len(size)), size), [np.asarray(c.flatten()).astype(np.int64) for c in columns]


def covered(starts: np.ndarray, ends: np.ndarray, row: np.ndarray, at: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Which bytes from starts[0] on lie in a span [at, stop) of their row's text."""
    lo = int(starts[0]) if len(starts) else 0
    n = int(ends[-1]) - lo if len(starts) else 0
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, starts[row] - lo + at, 1)
    np.add.at(d, starts[row] - lo + stop, -1)
    return np.cumsum(d[:n]) > 0


def group_sizes(length: int, q: int) -> list[int]:
    """Windows of a group in the rounds after the first: cores double from q bytes to a whole window."""
    cores = []
    while not cores or cores[-1] < length:
        cores.append(min(length, 2 * (cores[-1] if cores else q)))
    return [length - c + 1 for c in cores]


def _settle(rows: DataFrame, s: Scratch, kind: str, last: bool) -> tuple[DataFrame, DataFrame | None]:
    """Rank groups (r: rank so far, x: core, t: whole, id, v, at, n, a).

    Returns the groups that repeat an earlier one, and the firsts to be split further.
    """
    pairs = s.table(rows.groupBy("r", "x", "t").agg(F.min(F.struct("id", "at", "v", "n", "a")).alias("f"), F.count("*").alias("c")))
    many = pairs.filter("c > 1").select("r", "x", "t", F.col("f.id").alias("fid"), F.col("f.at").alias("fat"))
    later = rows.join(many, ["r", "x", "t"]).filter(~(F.col("id").eqNullSafe(F.col("fid")) & (F.col("at") == F.col("fat"))))
    later = s.table(later.select("id", "v", "at", "n"))
    firsts = None if last else _ranked(pairs.select("r", "x", "t", "f.*"), s, kind)
    s.drop(pairs)
    return later, firsts


_KEPT = ("id", "v", "at", "n", "a")


def _ranked(pairs: DataFrame, s: Scratch, kind: str) -> DataFrame:
    """(id, v, at, n, a, r): the pairs (r, x) in sorted order with their dense ranks, where a rank holds several wholes.

    The sort's ranges may cut a rank with very many wholes, so no range is one rank's; ranks count
    within a range, and the driver adds up one row a range.
    """
    key = ("r", "x")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, number, held = TaskContext.get().partitionId(), None, 0, None

        def out(b: pa.RecordBatch, rank: np.ndarray, twin: np.ndarray, end: bool) -> pa.RecordBatch:
            pick = pa.array(np.flatnonzero(twin | (rank == 1) | (end & (rank == rank[-1]))))
            cols = [b.column(c).take(pick) for c in (*key, *_KEPT)]
            own = [pa.array(x).take(pick) for x in (np.full(b.num_rows, part, np.int32), rank, twin)]
            return pa.RecordBatch.from_arrays([*cols, *own], [*key, *_KEPT, "part", "k", "twin"])

        for b in batches:
            if not b.num_rows:
                continue
            new = group_starts(b, key)
            new[0] = before is None or not same_group(before, before.num_rows - 1, b, 0, key)
            if held is not None:  # the batch before is known once this one's first row is
                if not new[0]:
                    held[1][-1] = True
                yield out(before, held[0], held[1], False)
            rank = number + np.cumsum(new)
            twin = ~new
            twin[:-1] |= ~new[1:]
            number, before, held = int(rank[-1]), b, (rank, twin)
        if held is not None:
            yield out(before, held[0], held[1], True)

    ordered = pairs.select(*key, "t", *_KEPT).repartitionByRange("r", "x", "t").sortWithinPartitions("r", "x", "t").drop("t")
    table = s.table(ordered.mapInArrow(scan, f"r long, x long, id {kind}, v long, at int, n int, a int, part int, k long, twin boolean"))
    pair = F.struct("r", "x")
    ends = table.groupBy("part").agg(F.min_by(pair, "k").alias("low"), F.max_by(pair, "k").alias("high"), F.max("k").alias("count")).orderBy("part").collect()
    offsets, total, last = [], 0, None
    for e in ends:  # (range, its offset, whether its first rank began before, whether its last goes on, its ranks)
        joined = e.low == last
        if joined:
            offsets[-1][3] = True
        offsets.append([e.part, total - joined, joined, False, e["count"]])
        total, last = total - joined + e["count"], e.high
    where = F.broadcast(pairs.sparkSession.createDataFrame(offsets, "part int, low long, joined boolean, goes_on boolean, ranks long"))  # a row a range
    across = (F.col("joined") & (F.col("k") == 1)) | (F.col("goes_on") & (F.col("k") == F.col("ranks")))
    out = s.table(table.join(where, "part").filter(F.col("twin") | across).select(*_KEPT, (F.col("low") + F.col("k")).alias("r")))
    s.drop(table)
    return out


def _split(documents: DataFrame, firsts: DataFrame, kind: str, length: int, m: int) -> DataFrame:
    """Groups of at most m windows of ``firsts``, with their rank so far, cores and wholes."""
    # the rank travels in two halves, so that all lists hold ints
    halves = firsts.select("id", "v", "at", "n", "a", F.shiftright("r", 32).cast("int").alias("h1"), F.expr("int(shiftright(shiftleft(r, 32), 32))").alias("h0"))
    mine = lists_by_document(halves, ("at", "n", "a", "h1", "h0"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, st, en = text_bytes(b.column(2))
            row, (at, n, a, h1, h0) = span_lists([b.column(3 + k) for k in range(5)])
            h = h1 << 32 | h0 & 0xFFFFFFFF
            for i, j in pieces(st, en, BLOCK):
                pick = np.flatnonzero((row >= i) & (row < j))
                if not len(pick):
                    continue
                lo = int(st[i])
                sym = byte_symbols(data[lo : int(en[j - 1])])
                near, far = Rolling(sym, BASE_A), Rolling(sym, BASE_B)
                high = (a - at)[pick]  # windows stand at offsets low..high before the anchor
                low = high - n[pick] + 1
                k0 = low // m
                count = high // m - k0 + 1
                of = np.repeat(np.arange(len(pick)), count)
                k = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + k0[of]
                i0, i1 = np.maximum(k * m, low[of]), np.minimum(k * m + m - 1, high[of])
                src = pick[of]
                anchor = a[src] + st[row[src]] - lo
                core = near.spans(anchor - k * m, anchor - k * m - m + 1 + length)
                whole = far.spans(anchor - i1, anchor - i0 + length)
                core = mix(core + mix(k.astype(np.uint64) * U(BASE_B)))
                pair = mix(whole + mix((i1 * 4096 + i1 - i0).astype(np.uint64)))
                place = a[src]
                yield _taken(b, row[src], ["r", "x", "t", "at", "n", "a"], pa.array(h[src]), _long(core), _long(pair), *(pa.array(x.astype(np.int32)) for x in (place - i1, i1 - i0 + 1, place)))

    return with_spans(documents, mine, "inner").mapInArrow(scan, f"id {kind}, v long, r long, x long, t long, at int, n int, a int")


def repeated_windows(documents: DataFrame, s: Scratch, length: int = 100, q: int = 20) -> DataFrame:
    """(id, v, at, n): windows that start at at..at+n-1 and also start earlier, every one of them."""
    kind = documents.schema["id"].dataType.simpleString()

    def ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, rank, *_ in anchors(*text_bytes(b.column(0)), length, q):
                yield pa.RecordBatch.from_arrays([_long(rank)], ["h"])

    shared = documents.select("text").mapInArrow(ranks, "h long").groupBy("h").agg(F.count("*").alias("c")).filter("c > 1").select("h")
    shared = s.table(shared)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t, rank, whole, at, n, a in anchors(*text_bytes(b.column(2)), length, q):
                place = at.astype(np.int64) << 16 | n << 8 | a - at  # one column: rows are many
                yield _taken(b, t, ["h", "t", "p"], _long(rank), _long(whole), pa.array(place))

    live = documents.mapInArrow(scan, f"id {kind}, v long, h long, t long, p long").join(shared, "h", "left_semi")
    at = F.shiftright("p", 16)
    live = s.table(live.select("id", "v", F.lit(0).cast("long").alias("r"), F.col("h").alias("x"), "t", at.cast("int").alias("at"), F.expr("int(shiftright(p, 8) & 255)").alias("n"), (at + F.expr("p & 255")).cast("int").alias("a")))
    s.drop(shared)
    out, firsts = _settle(live, s, kind, last=False)
    s.drop(live)
    for m in group_sizes(length, q):
        rows = s.table(_split(documents, firsts, kind, length, m))
        s.drop(firsts)
        later, firsts = _settle(rows, s, kind, last=m == 1)
        s.drop(rows)
        out = out.unionByName(later)
    return out


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 100,
    keep: str = "",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document row: (id_col, n_bytes, n_removed, n_spans, kept_sha256[, kept], carried columns).

    A byte goes if it lies in a string of ``length`` bytes that also starts earlier: in a
    document with a smaller id, or earlier in its own.  Strings are judged on the input.
    ``kept`` is the rest: as binary with keep="bytes", as a string with keep="text", where a
    character that was cut in two goes whole.  Null and empty texts have no bytes.  Rows with one id
    stand at the same place and do not remove each other's equal places; a null id
    comes first.  An empty table gives no rows.  Only two columns are read.
    """
    documents = _documents(docs, id_col, text_col, carry)
    s = Scratch(docs.sparkSession, "suffix")
    gone = lists_by_document(repeated_windows(documents.select("id", "v", "text"), s, length), ("at", "n"))
    kind = documents.schema["id"].dataType.simpleString()

    def rest(data: np.ndarray, st: np.ndarray, en: np.ndarray, row: np.ndarray, fields: list[np.ndarray]) -> Iterator[tuple]:
        at, n = fields
        for i, j in pieces(st, en, BLOCK):
            pick = np.flatnonzero((row >= i) & (row < j))
            lo = int(st[i])
            hit = covered(st[i:j], en[i:j], row[pick] - i, at[pick], at[pick] + n[pick] - 1 + length)
            for x, y in zip(st[i:j] - lo, en[i:j] - lo):
                m = hit[x:y]
                size = int(m.sum())
                kept = data[lo + x : lo + y][~m].tobytes() if size else data[lo + x : lo + y].tobytes()
                runs = int((m[1:] & ~m[:-1]).sum() + m[:1].sum()) if size else 0
                yield int(y - x), size, runs, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore") if keep == "text" else kept

    return finish(documents, gone, rest, kind, ["n_bytes long", "n_removed long", "n_spans long", "kept_sha256 string"] + [f"kept {'string' if keep == 'text' else 'binary'}"] * bool(keep)).withColumnsRenamed({"id": id_col} | {f"_c{k}": c for k, c in enumerate(carry)})


_ARROW = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def finish(documents: DataFrame, gone: DataFrame, rest: Callable, kind: str, fields: list[str]) -> DataFrame:
    """Apply ``rest`` to every document with its spans; carried columns follow."""
    names = [f.split()[0] for f in fields]
    carried = [f for f in documents.schema.fields if f.name.startswith("_c")]
    types = [_ARROW[f.split()[1]] for f in fields]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, st, en = text_bytes(b.column(2))
            if not len(st):
                continue
            rows = list(zip(*rest(data, st, en, *span_lists([b.column(3 + k) for k in range(width)]))))
            extra = [b.column(3 + width + k) for k in range(len(carried_names))]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(r, t) for r, t in zip(rows, types)), *extra], ["id", *names, *carried_names])

    carried_names = [f.name for f in carried]
    width = len(gone.columns) - 2
    schema = ", ".join([f"id {kind}", *fields, *(f"{f.name} {f.dataType.simpleString()}" for f in carried)])
    return with_spans(documents, gone, "left").mapInArrow(scan, schema)
