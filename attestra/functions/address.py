"""Freeform addresses in parts, as one column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Printed country names and their ISO codes; postal forms by country.
COUNTRIES = {"CANADA": "CA", "CA": "CA", "GB": "GB", "UK": "GB", "UNITED KINGDOM": "GB", "UNITED STATES": "US", "US": "US", "USA": "US"}
POSTAL = (("US", r"\b\d{5}(?:-\d{4})?$"), ("CA", r"\b[A-Z]\d[A-Z] ?\d[A-Z]\d$"), ("GB", r"\b[A-Z]{1,2}\d[A-Z\d]? ?\d[A-Z]{2}$"))


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def parse_address(c: Column) -> Column:
    """struct(line1, line2, city, region, postal, country, reason) of comma- or line-parted text.

    A last part that names a country is taken off; then the postal code at the end of the last
    part (of the named country, else of the first that fits), then a two-letter region; what
    is left is the city, or else the part before.  Without a line and a city the reason is
    ``address_parse_incomplete``; a postal code of another country is a mismatch.
    """
    parts = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"[,\n]+"), lambda p: F.trim(p)), lambda p: p != "")
    table = F.create_map(*(F.lit(x) for kv in COUNTRIES.items() for x in kv))

    def with_country(p: Column) -> Column:
        named = F.when(F.size(p) > 0, table[F.upper(F.element_at(p, -1))])
        body = F.when(named.isNotNull(), F.slice(p, 1, F.size(p) - 1)).otherwise(p)
        return _let(F.struct(named.alias("country"), body.alias("parts"), F.when(F.size(body) > 0, F.element_at(body, -1)).otherwise("").alias("last")), with_postal)

    def with_postal(s: Column) -> Column:
        upper = F.upper(s["last"])
        code = kind = F.lit(None).cast("string")
        for country, pattern in reversed(POSTAL):
            hit = F.regexp_extract(upper, pattern, 0)
            fits = (hit != "") & (s["country"].isNull() | (s["country"] == country))
            code, kind = F.when(fits, hit).otherwise(code), F.when(fits, F.lit(country)).otherwise(kind)
        other = F.lit(False)
        for country, pattern in POSTAL:
            other = other | ((s["country"] != country) & (F.regexp_extract(upper, pattern, 0) != ""))
        mismatch = code.isNull() & F.coalesce(other, F.lit(False))
        rest = F.when(code.isNotNull(), F.trim(F.substr(s["last"], F.lit(1), F.length(s["last"]) - F.length(code)))).otherwise(s["last"])
        return _let(F.struct(F.coalesce(s["country"], kind).alias("country"), s["parts"].alias("parts"), F.regexp_replace(code, " ", "").alias("postal"), rest.alias("rest"), mismatch.alias("mismatch")), with_region)

    def with_region(s: Column) -> Column:
        region = F.nullif(F.regexp_extract(s["rest"], r"\b([A-Z]{2})$", 1), F.lit(""))
        rest = F.when(region.isNotNull(), F.trim(F.regexp_replace(s["rest"], r"\b[A-Z]{2}$", ""))).otherwise(s["rest"])
        head = F.slice(s["parts"], 1, F.greatest(F.size(s["parts"]) - 1, F.lit(0)))
        return _let(F.struct(s["country"].alias("country"), s["postal"].alias("postal"), region.alias("region"), rest.alias("rest"), head.alias("head"), s["mismatch"].alias("mismatch")), with_city)

    def with_city(s: Column) -> Column:
        own = s["rest"] != ""
        before = F.when(F.size(s["head"]) > 0, F.element_at(s["head"], -1))
        apart = ~own & s["region"].isNull() & before.rlike("^[A-Z]{2}$")  # a region in its own part
        keep = F.size(s["head"]) - F.when(own, 0).when(apart, 2).otherwise(1)
        city = F.when(own, s["rest"]).when(apart, F.get(s["head"], F.size(s["head"]) - 2)).otherwise(before)
        lines = F.slice(s["head"], F.lit(1), F.greatest(keep, F.lit(0)))
        line1 = F.get(lines, F.lit(0))
        line2 = F.nullif(F.array_join(F.slice(lines, F.lit(2), F.greatest(F.size(lines), F.lit(1))), ", "), F.lit(""))
        reason = F.when(line1.isNull() | city.isNull(), "address_parse_incomplete").when(s["mismatch"], "address_country_postal_mismatch")
        return F.struct(line1.alias("line1"), line2.alias("line2"), city.alias("city"), F.coalesce(s["region"], F.when(apart, before)).alias("region"), s["postal"].alias("postal"), s["country"].alias("country"), reason.alias("reason"))

    return _let(parts, with_country)
