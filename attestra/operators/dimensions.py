"""Dimensions and counters over documents and lines: corpus counts, items, accounts, usage cost, cut names, nearest pages."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import Scratch
from ..shipping import ship
from . import entities


def corpus_counters(documents: DataFrame, columns: list[str]) -> DataFrame:
    """(counter, value, documents) for each column, in one pass."""
    sides = F.array(*(F.struct(F.lit(c).alias("counter"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")) for c in columns))
    return documents.select(F.explode(sides).alias("s")).groupBy("s.counter", "s.value").agg(F.count(F.lit(1)).alias("documents"))


def items(lines: DataFrame, name: str, document: str) -> DataFrame:
    """Items by folded identity: rows, distinct documents, most frequent spelling (ties to the smallest)."""
    folded = lines.withColumn("item", F.lower(F.regexp_replace(F.trim(F.col(name)), r"\s+", " ")))
    docs = folded.groupBy("item").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(document).alias("documents"))
    per = folded.groupBy("item", name).agg(F.count(F.lit(1)).alias("n"))
    best = per.groupBy("item").agg(F.min(F.struct((-F.col("n")).alias("m"), F.col(name).alias("spelling"))).alias("b"), F.count(F.lit(1)).alias("spellings"))
    return docs.join(best, "item").select("item", F.col("b.spelling").alias("spelling"), "spellings", "rows", "documents")


def accounts(documents: DataFrame, party: str, day: str, key: str) -> DataFrame:
    """Rows, distinct documents, first and last day of each party."""
    return documents.groupBy(party).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(key).alias("documents"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def usage_cost(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Cost of each model: a request is priced once (its largest record), cached tokens apart.  prices (model, input, cached, output) a million."""
    once = usage.withColumn("_k", F.row_number().over(Window.partitionBy("request_id").orderBy(F.desc("output_tokens"), F.desc("input_tokens"), "model"))).filter("_k = 1")
    rate = {c: F.col(c).cast("decimal(12,4)") for c in ("input", "cached", "output")}
    cost = (F.col("input_tokens") - F.col("cached_tokens")) * rate["input"] + F.col("cached_tokens") * rate["cached"] + F.col("output_tokens") * rate["output"]
    priced = once.join(F.broadcast(prices), "model", "left")
    return priced.groupBy("model").agg(F.count(F.lit(1)).alias("requests"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), F.round(F.sum(cost).cast("double") / 1e6, 9).alias("cost"), F.max(F.col("input").isNull().cast("int")).alias("unpriced"))


def untestable_money(lines: DataFrame, document: str, label: str, amount: str) -> DataFrame:
    """Money and rows on documents where no line can be tested."""
    per = lines.groupBy(document).agg(F.max(F.col(label).isin("reconciles", "does_not_reconcile").cast("int")).alias("tested"), F.sum(amount).alias("money"), F.count(F.when(F.col(amount) != 0, 1)).alias("rows"))
    return per.agg(F.coalesce(F.sum(F.when(F.coalesce("tested", F.lit(0)) == 0, F.col("money"))), F.lit(0)).cast("decimal(38,2)").alias("untestable"), F.coalesce(F.sum(F.when(F.coalesce("tested", F.lit(0)) == 0, F.col("rows"))), F.lit(0)).alias("rows"), F.sum("money").cast("decimal(38,2)").alias("total"))


def completed_names(names: DataFrame, least: int = 6) -> DataFrame:
    """(name, completed): names cut inside a word and the one maximal longer name that goes on with a letter.

    Candidates share their first ``least`` letters, so the join is by that prefix.
    """
    n = names.select("name").distinct().filter(F.length("name") >= least).withColumn("p", F.substring("name", 1, least))
    a, b = n.alias("a"), n.alias("b")
    longer = (F.length("b.name") > F.length("a.name")) & F.startswith(F.col("b.name"), F.col("a.name"))
    cut = a.join(b, (F.col("a.p") == F.col("b.p")) & longer).select(F.col("a.name").alias("name"), F.col("b.name").alias("longer"))
    cut = cut.filter(F.substr("longer", F.length("name") + 1, F.lit(1)).rlike("[a-zA-Z]"))
    inner = cut.select(F.col("name").alias("longer")).distinct()  # a longer name that is itself cut is not maximal
    ends = cut.join(inner, "longer", "left_anti")
    return ends.groupBy("name").agg(F.count(F.lit(1)).alias("k"), F.min("longer").alias("completed")).filter("k = 1").select("name", "completed")


#: Words that a matrix holds, each on one in twenty of the pages held or more; settled pages held against them at once, and pages held in a tile.
DENSE, DENSE_SHARE, AT_ONCE, TILE = 512, 20, 128, 4096


class _Held:
    """Pages that seek their nearest: a matrix of their commonest words, and for every other word the pages that carry it."""

    def __init__(self, table: pa.Table):
        words = pc.dictionary_encode(pa.array(pc.list_flatten(table["words"]).combine_chunks()), null_encoding="encode")
        codes = np.asarray(words.indices)
        self.ids, self.sizes = table["page_id"].combine_chunks(), np.asarray(pc.list_value_length(table["words"])).astype(np.int64)
        counts = np.bincount(codes, minlength=len(words.dictionary))
        order = np.argsort(-counts, kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order))
        codes, rows = place[codes], np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)
        self.vocabulary, dense = words.dictionary.take(pa.array(order)), min(DENSE, int((counts * DENSE_SHARE >= len(self.sizes)).sum()))
        columns = np.zeros((dense, len(self.sizes)), np.float32)
        columns[codes[codes < dense], rows[codes < dense]] = 1
        self.dense, self.tiles = dense, [(x, np.ascontiguousarray(columns[:, x : x + TILE])) for x in range(0, len(self.sizes), TILE)]
        rest = codes[codes >= dense] - dense
        self.rows = rows[codes >= dense][np.argsort(rest, kind="stable")]
        self.ends = np.concatenate([[0], np.cumsum(np.bincount(rest, minlength=len(order) - dense))])
        self.own = self.ids.unique()
        self.own_at = np.asarray(pc.index_in(self.ids, value_set=self.own))

    def _rest(self, codes: np.ndarray, sizes: np.ndarray, out: np.ndarray) -> None:
        """How many words beside the matrix each settled page shares with each page held."""
        for i, (end, size) in enumerate(zip(np.cumsum(sizes), sizes, strict=True)):
            mine = codes[end - size : end]
            mine = mine[mine >= self.dense] - self.dense
            hits = [self.rows[x:y] for x, y in zip(self.ends[mine].tolist(), self.ends[mine + 1].tolist(), strict=True)]
            out[i] = np.bincount(np.concatenate(hits), minlength=out.shape[1]) if hits else 0

    def _near(self, codes: np.ndarray, sizes: np.ndarray, floor: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(settled page, page held, words shared) wherever these are at least ``floor`` of both sizes."""
        marks = np.zeros((len(sizes), self.dense), np.float32)
        top = (codes >= 0) & (codes < self.dense)
        marks[np.repeat(np.arange(len(sizes)), sizes)[top], codes[top]] = 1
        self._rest(codes, sizes, rest[: len(sizes)])
        found = []
        for x, columns in self.tiles:
            y = x + columns.shape[1]
            shared = marks @ columns
            shared += rest[: len(sizes), x:y]
            bound = np.multiply.outer(sizes.astype(np.float32), floor[x:y])
            bound += floor[x:y] * self.sizes[x:y].astype(np.float32)
            row, page = np.divmod(np.flatnonzero(shared >= bound), y - x)
            found.append((row, page + x, shared[row, page]))
        return tuple(np.concatenate(f) for f in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3

    def nearest(self, batches: Iterable[pa.RecordBatch], k: int) -> pa.RecordBatch | None:
        """(page_id, s_id, label, like): the k most alike of all ``batches`` for each page held, larger ids first among equals.

        A settled page is looked at closely where it may be as alike as the k-th so far; small first steps soon raise that.
        """
        n, step, pool = len(self.sizes), min(8, AT_ONCE), None
        like, ref, least, floor = np.full((n, k), -1.0), np.zeros((n, k), np.int64), np.full(n, -1.0), np.zeros(n, np.float32)
        rest = np.empty((AT_ONCE, n), np.float32)
        for batch in batches:
            codes = np.asarray(pc.fill_null(pc.index_in(pc.list_flatten(batch.column("words")), value_set=self.vocabulary), -1)).astype(np.int64)
            sizes = np.asarray(pc.list_value_length(batch.column("words"))).astype(np.int64)
            own = np.asarray(pc.fill_null(pc.index_in(batch.column("page_id"), value_set=self.own), -1))
            starts, at = np.concatenate([[0], np.cumsum(sizes)]), 0
            known = pa.table([batch.column("page_id"), batch.column("label")], names=["s_id", "label"])
            while at < len(sizes):
                to = min(at + step, len(sizes))
                step = min(2 * step, AT_ONCE)
                row, page, common = self._near(codes[starts[at] : starts[to]], sizes[at:to], floor, rest)
                common = common.astype(np.float64)
                alike = common / np.maximum(sizes[at + row] + self.sizes[page] - common, 1)
                keep = (alike >= least[page]) & (own[at + row] != self.own_at[page])
                row, page, alike = row[keep] + at, page[keep], alike[keep]
                at = to
                if not len(page):
                    continue
                # the old best of the pages concerned and the new ones, in one order
                some, new = np.unique(row, return_inverse=True)
                base = 0 if pool is None else len(pool)
                pool = known.take(pa.array(some)) if pool is None else pa.concat_tables([pool, known.take(pa.array(some))])
                touched, mine = np.unique(page, return_inverse=True)
                had = like[touched] >= 0
                whose = np.concatenate([mine, np.nonzero(had)[0]])
                alike, refs = np.concatenate([alike, like[touched][had]]), np.concatenate([new + base, ref[touched][had]])
                ranks = np.asarray(pool["s_id"]) if pa.types.is_integer(pool["s_id"].type) else np.asarray(pc.rank(pool["s_id"], "ascending", tiebreaker="dense")).astype(np.int64)
                order = np.lexsort((-ranks[refs], -alike, whose))
                whose, alike, refs = whose[order], alike[order], refs[order]
                nth = np.arange(len(whose)) - np.searchsorted(whose, whose)
                best = nth < k
                put = (touched[whose[best]], nth[best])
                like[put], ref[put] = alike[best], refs[best]
                least[touched] = like[touched, k - 1]
                # like >= least where shared >= least / (1 + least) * (both sizes); a little below that for single precision
                floor[touched] = np.where(least[touched] > 0, least[touched] / (1 + least[touched]) * (1 - 1e-6), 0)
                if len(pool) > 2 * n * k + 10_000:
                    used, back = np.unique(ref, return_inverse=True)
                    pool, ref = pool.take(pa.array(used)).combine_chunks(), back.reshape(ref.shape)
        if pool is None:
            return None
        page, nth = np.nonzero(like >= 0)
        found = pool.take(pa.array(ref[page, nth])).combine_chunks()
        return pa.RecordBatch.from_arrays([self.ids.take(pa.array(page)), *(found[c].combine_chunks() for c in ("s_id", "label")), pa.array(like[page, nth])], names=["page_id", "s_id", "label", "like"])


def nearest(pages: DataFrame, settled: DataFrame, k: int = 5, least: float = 0.3, block_words: int = 32_000_000) -> DataFrame:
    """(page_id, label): the one label of the k settled pages with the most alike layout words.

    pages and settled are (page_id, words[, label]).  Every page is held against every settled
    page but itself, also where they share no word; of equally alike ones the larger id comes
    first.  The side of fewer rows goes to the executors in blocks of about ``block_words``
    words and matrix cells, one after another, and the other side is read once a block; a task keeps the
    k best of what it reads, so memory does not grow with the tables.  The work grows with pages times settled pages.
    """
    spark = pages.sparkSession
    ship(spark)
    words = F.coalesce(F.array_distinct("words"), F.array().cast("array<string>")).alias("words")
    p = pages.filter("page_id is not null").select("page_id", words)
    s = settled.filter("page_id is not null").select("page_id", words, "label")
    p = p.withColumn("page_id", F.col("page_id").cast(s.schema["page_id"].dataType))
    kind = f"page_id {s.schema['page_id'].dataType.simpleString()}, s_id {s.schema['page_id'].dataType.simpleString()}, label {s.schema['label'].dataType.simpleString()}, like double"
    hold = p.count() <= s.count()
    sent, read = (p, s) if hold else (s, p)
    blocks = -(-(sent.agg(F.sum(F.size("words") + 1 + DENSE)).first()[0] or 1) // block_words)
    scratch = Scratch(spark, "nearest") if blocks > 1 else None
    first = F.row_number().over(Window.partitionBy("page_id").orderBy(F.desc("like"), F.desc("s_id")))
    top = None
    for b in range(blocks):
        table = sent.filter(F.pmod(F.xxhash64("page_id"), F.lit(blocks)) == b).toArrow()
        block = spark.sparkContext.broadcast(_Held(table) if hold else table)

        def near(batches, block=block):
            sought = [(block.value, batches)] if hold else ((_Held(pa.Table.from_batches([batch])), block.value.to_batches()) for batch in batches)
            for held, others in sought:
                if (found := held.nearest(others, k)) is not None:
                    yield found

        found = read.mapInArrow(near, kind)
        top = (found if top is None else top.unionByName(found)).withColumn("r", first).filter(F.col("r") <= k).drop("r")
        if blocks > 1:
            top = scratch.table(top)
            block.unpersist()
    out = top.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"), F.max("like").alias("best"), F.countDistinct("label").alias("labels"), F.min("label").alias("label"))
    return out.filter((F.col("n") == k) & (F.col("best") >= least) & (F.col("labels") == 1)).select("page_id", "label", F.round("best", 6).alias("likeness"))
