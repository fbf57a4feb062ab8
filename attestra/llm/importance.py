"""Target-distribution importance resampling over a dictionary of distinct n-gram strings.

Documents are read in pieces of some megabytes.  A piece sends each of its distinct n-grams
once, with the documents that hold it and how often, to the slot that the n-gram's hash
names.  A slot has every string of its share of the dictionary, hashes each distinct one
once into its bucket, and adds the counts up.  When all buckets are summed their gains are
known; each piece then gets its documents' counts back by bucket, and the gains are joined to
them.

Strings travel packed by piece and slot.  The number of slots follows the bytes of text, so
what a slot holds is bounded; an n-gram that many documents of one piece hold goes to a slot
of the piece's own, so no string brings all its documents to one task.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch
from .bytespan import BASE_A, BASE_B, LONG_SPAN, Rolling, U, Words, chained, mix, pieces, text_bytes
from .decontaminate import GAPS

#: Bytes of text in a piece, and of text whose n-grams share a slot.
PIECE, SLOT = 4 << 20, 4 << 20
#: Documents of a piece beyond which an n-gram goes to the piece's own slot.
COMMON = 512
_TOP = 40  # the top 24 bits of a hash name its slot


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = (c >> 1) ^ np.where(c & 1, np.uint32(0xEDB88320), np.uint32(0))
    return c


_CRC = _crc_table()


def crc32_spans(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The unsigned crc32 of each span of bytes."""
    c = np.full(len(start), 0xFFFFFFFF, np.uint32)
    size = stop - start
    live = np.flatnonzero((size > 0) & (size <= LONG_SPAN))
    step = 0
    while len(live):
        now = c[live]
        c[live] = _CRC[(now ^ data[start[live] + step]) & 255] ^ (now >> 8)
        step += 1
        live = live[size[live] > step]
    c ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > LONG_SPAN):
        c[i] = zlib.crc32(data[start[i] : stop[i]])
    return c


def _pack(*columns: np.ndarray) -> tuple[int, bytes]:
    """(size, compressed) of unsigned numbers below 2**32, each column by its four byte planes; bytes as they are."""
    raw = bytearray()
    for x in columns:
        raw += np.uint64(len(x)).tobytes()
        raw += x.tobytes() if x.dtype == np.uint8 else np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
    return len(raw), pa.Codec("zstd", 6).compress(bytes(raw), asbytes=True)


def _unpack(size: int, packed: bytes, kinds: str) -> list[np.ndarray]:
    """The columns of :func:`_pack`; ``kinds`` has b for bytes and n for numbers."""
    raw = np.frombuffer(pa.decompress(packed, decompressed_size=size, codec="zstd"), np.uint8)
    out, at = [], 0
    for k in kinds:
        n = int(raw[at : at + 8].view("<u8")[0])
        at += 8
        width = n if k == "b" else 4 * n
        x = raw[at : at + width]
        out.append(x if k == "b" else np.ascontiguousarray(x.reshape(4, n).T).view("<u4").ravel())
        at += width
    return out


def _piece(data: np.ndarray, s: np.ndarray, e: np.ndarray, n: int, slots: int, name: bytes) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, bytes]]]:
    """(words of each text, its features, (slot, size, packed features))."""
    w = Words(data, s, e, GAPS, fold=True)
    words = w.after - w.first
    features = sum(np.maximum(words - k, 0) for k in range(n))
    if not len(w.start):
        return words, features, []
    # all words joined by one space, so that each n-gram is one span
    size = w.stop - w.start
    begin = np.cumsum(size + 1) - (size + 1)
    joined = np.full(int(begin[-1] + size[-1] + 1), 0x20, np.uint8)
    inside = np.ones(len(joined), bool)
    inside[begin + size] = False
    joined[inside] = w.bytes[~GAPS[w.bytes]]
    one, two = Rolling(w.hash), Rolling(w.second, BASE_B)
    at = [np.flatnonzero(w.fits(k)[: max(len(size) - k + 1, 0)]) for k in range(1, n + 1)]
    kind = np.repeat(np.arange(n, dtype=np.uint64), [len(x) for x in at])
    start = np.concatenate([begin[x] for x in at])
    length = np.concatenate([begin[x + k] + size[x + k] for k, x in enumerate(at)]) - start
    doc = np.concatenate([w.text[x] for x in at])
    h = mix(np.concatenate([one.windows(k + 1)[x] for k, x in enumerate(at)]) ^ mix(kind + U(1)))
    g = np.concatenate([two.windows(k + 1)[x] for k, x in enumerate(at)])
    del w, one, two, at, kind, inside, begin, size
    # one sort brings equal n-grams together, in text order; neighbours that differ in either hash part groups
    bits = U(max(len(h).bit_length(), 1))
    order = (np.sort((h >> bits << bits) | np.arange(len(h), dtype=np.uint64)) & ((U(1) << bits) - U(1))).astype(np.int64)
    h, g, doc = h[order], g[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
    fresh = new.copy()
    fresh[1:] |= doc[1:] != doc[:-1]
    post = np.flatnonzero(fresh)  # a posting: one n-gram in one document
    count = np.diff(np.append(post, len(h)))
    first = np.flatnonzero(new)
    of = np.searchsorted(post, first)  # of each distinct n-gram: its first posting
    held = np.diff(np.append(of, len(post)))
    slot = ((h[first] >> U(_TOP)) * U(slots) >> U(64 - _TOP)).astype(np.int64)
    slot[held > COMMON] = slots
    start, length, who = start[order[first]], length[order[first]], doc[post]
    del h, g, doc, new, fresh, order, post, first
    by = np.argsort(slot << 32 | who[of], kind="stable")  # in a slot by first document, so that the steps between them are small
    out = []
    for a, b in zip(*_runs(slot[by])):
        f = by[a:b]
        p = _spans(of[f], held[f])
        where = int(slot[f[0]])
        out.append((where if where < slots else int.from_bytes(name[:8], "big") % slots, *_pack(joined[_spans(start[f], length[f])], length[f], held[f], _steps(who[p], held[f]), count[p])))
    return words, features, out


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places in spans, one span after another."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - size), size)


def _steps(who: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Ascending documents of n-grams as steps: from the one before, or from the first of the n-gram before."""
    head = np.cumsum(held) - held
    out = np.diff(who, prepend=0)
    out[head] = np.diff(who[head], prepend=0)
    return out


def _documents(steps: np.ndarray, held: np.ndarray) -> np.ndarray:
    """What :func:`_steps` was made of."""
    head = np.cumsum(held) - held
    out = steps.astype(np.int64)
    firsts = np.cumsum(out[head])
    out[head] = 0
    run = np.cumsum(out)
    return run + np.repeat(firsts - run[head], held)


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, stops) of runs of equal neighbours."""
    start = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, np.int64)
    return start, np.append(start[1:], len(x)) if len(x) else start


def _buckets_of(strings: np.ndarray, length: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each string; every distinct one is hashed once."""
    stop = np.cumsum(length.astype(np.int64))
    start = stop - length
    h, g = chained(strings, start, stop, BASE_B), chained(strings, start, stop, BASE_A)
    _, first, back = np.unique(h, return_index=True, return_inverse=True)
    bucket = (crc32_spans(strings, start[first], stop[first]) % np.uint32(buckets))[back]
    odd = np.flatnonzero(g != g[first][back])  # two strings of one hash
    bucket[odd] = crc32_spans(strings, start[odd], stop[odd]) % np.uint32(buckets)
    return bucket


_WIDE = "kind int, slot int, piece binary, size long, packed binary"


def _dictionary(s: Scratch, docs: DataFrame, n: int, buckets: int) -> DataFrame:
    """A written table of three kinds: 0 a piece's counts by bucket, 1 its documents, 2 sums by bucket.

    ``docs`` has id and text.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slots = max(1, -(-total // SLOT))
    id_kind = docs.schema["id"].dataType.simpleString()
    more = f"ids array<{id_kind}>, words array<long>, features array<long>"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, ordinal = TaskContext.get().partitionId(), 0
        for b in batches:
            ids, (data, st, en) = b.column(0), text_bytes(b.column(1))
            for i, j in pieces(st, en, PIECE):
                ordinal += 1
                # a task that runs again on other rows makes pieces of other names, which then lack their documents
                name = hashlib.sha256(f"{task} {ordinal} {ids.slice(i, j - i).to_pylist()}".encode()).digest()[:16]
                words, features, rows = _piece(data, st[i:j], en[i:j], n, slots, name)
                m = len(rows)
                lists = lambda x: pa.ListArray.from_arrays(pa.array([0] * (m + 1) + [j - i], pa.int32()), x)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([0] * m + [1], pa.int32()),
                        pa.array([r[0] for r in rows] + [int.from_bytes(name[:8], "big") % slots], pa.int32()),
                        pa.array([name] * (m + 1), pa.binary()),
                        pa.array([r[1] for r in rows] + [None], pa.int64()),
                        pa.array([r[2] for r in rows] + [None], pa.binary()),
                        lists(ids.slice(i, j - i)),
                        lists(pa.array(words)),
                        lists(pa.array(features)),
                    ],
                    ["kind", "slot", "piece", "size", "packed", "ids", "words", "features"],
                )

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        slot, held = None, []
        for b in batches:
            where = b.column("slot").to_pylist()
            for r in range(b.num_rows):
                if where[r] != slot:
                    yield from resolve(held, sums)
                    slot, held = where[r], []
                if b.column("kind")[r].as_py() == 1:
                    yield pa.RecordBatch.from_arrays([*(b.column(c).slice(r, 1) for c in ("kind", "piece", "size", "packed", "ids", "words", "features")), pa.nulls(1, pa.list_(pa.int64()))], names)
                else:
                    held.append((b.column("piece")[r].as_py(), b.column("size")[r].as_py(), b.column("packed")[r].as_py()))
        yield from resolve(held, sums)
        empty = [pa.nulls(1, k) for k in (pa.binary(), pa.int64(), pa.binary())]
        yield pa.RecordBatch.from_arrays([pa.array([2], pa.int32()), *empty, pa.nulls(1, lists[0]), pa.nulls(1, lists[1]), pa.nulls(1, lists[1]), pa.array([sums], pa.list_(pa.int64()))], names)

    def resolve(held: list[tuple[bytes, int, bytes]], sums: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        each = [_unpack(size, packed, "bnnnn") for _, size, packed in held]
        bucket = _buckets_of(np.concatenate([x[0] for x in each]), np.concatenate([x[1] for x in each]), buckets)
        at = 0
        rows = []
        for (piece, _, _), (_, length, n_docs, who, count) in zip(held, each):
            n_docs = n_docs.astype(np.int64)
            mine = np.repeat(bucket[at : at + len(length)], n_docs)
            at += len(length)
            np.add.at(sums, mine, count.astype(np.int64))
            who = _documents(who, n_docs)
            by = np.argsort(who, kind="stable")
            rows.append((piece, *_pack(mine[by], np.diff(who[by], prepend=0), count[by])))
        m = len(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array([0] * m, pa.int32()), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary()), pa.nulls(m, lists[0]), pa.nulls(m, lists[1]), pa.nulls(m, lists[1]), pa.nulls(m, pa.list_(pa.int64()))], names
        )

    names = ["kind", "piece", "size", "packed", "ids", "words", "features", "sums"]
    lists = (pa.list_(_arrow(docs)), pa.list_(pa.int64()))
    sent = docs.mapInArrow(scan, f"{_WIDE}, {more}").repartition("slot").sortWithinPartitions("slot")
    return s.table(sent.mapInArrow(settle, f"kind int, piece binary, size long, packed binary, {more}, sums array<long>"))


def _arrow(docs: DataFrame) -> pa.DataType:
    return docs.select("id").limit(0).toArrow().schema.field("id").type


def _totals(table: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket; a task adds its sums up before they leave it, one row a bucket comes to the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            total += np.asarray(b.column(0).flatten()).reshape(-1, buckets).sum(axis=0)
        live = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(live, pa.int32()), pa.array(total[live])], ["bucket", "n"])

    rows = table.filter("kind = 2").select("sums").mapInArrow(add, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r.bucket] = r.n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of each of B buckets, S and T the totals."""
    b, total_s, total_t = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (total_s + b) / ((s + 1) * (total_t + b)))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def importance_weights(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", n: int = 2, buckets: int = 10_000) -> DataFrame:
    """One row per document row: id, n_words, n_features, weight.

    Features are all runs of 1 to ``n`` words, joined by one space; words are those of
    :func:`~attestra.llm.decontaminate.normal_words`.  ``weight`` is the floored mean of the
    gains of a document's features, repeats counted, and 0 if it has none.  Null and empty
    texts have no features; every row counts for itself, rows of one id and repeated rows too.
    An empty target gives its buckets the smoothed count alone; no documents give no rows.
    """
    s = Scratch(docs.sparkSession, "importance")
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = plain.schema["id"].dataType.simpleString()
    aim = _dictionary(s, target.select(F.lit(0).alias("id"), F.col(target_text_col).cast("string").alias("text")), n, buckets)
    table = _dictionary(s, plain, n, buckets)
    held = docs.sparkSession.sparkContext.broadcast(bucket_gains(_totals(table, buckets), _totals(aim, buckets)))  # one number a bucket
    s.drop(aim)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = held.value
        now, ids, words, features, sums = None, None, None, None, None

        def done() -> Iterator[pa.RecordBatch]:
            if now is not None:
                weight = np.where(features > 0, sums // np.maximum(features, 1), 0)
                yield pa.RecordBatch.from_arrays([ids, pa.array(words), pa.array(features), pa.array(weight)], ["id", "n_words", "n_features", "weight"])

        for b in batches:
            for r in range(b.num_rows):
                piece = b.column("piece")[r].as_py()
                if b.column("kind")[r].as_py() == 1:  # a piece's documents come before its counts
                    yield from done()
                    now, ids = piece, b.column("ids").slice(r, 1).flatten()
                    words, features = (np.asarray(b.column(c).slice(r, 1).flatten()) for c in ("words", "features"))
                    sums = np.zeros(len(words), np.int64)
                    continue
                if piece != now:
                    raise RuntimeError("the rows of the documents changed between two runs of one task")
                bucket, step, count = _unpack(b.column("size")[r].as_py(), b.column("packed")[r].as_py(), "nnn")
                np.add.at(sums, np.cumsum(step, dtype=np.int64), gains[bucket] * count)
        yield from done()

    back = table.filter("kind < 2").select("piece", "kind", "size", "packed", "ids", "words", "features").repartition("piece").sortWithinPartitions("piece", F.col("kind").desc())
    return back.mapInArrow(join, f"id {kind}, n_words long, n_features long, weight long").withColumnRenamed("id", id_col)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", n: int = 2, buckets: int = 10_000, percent: int = 25, min_words: int = 20, seed: int = 7) -> DataFrame:
    """:func:`importance_weights` with score and rank: the documents drawn to resemble the target.

    The score is the weight with Gumbel noise of the id's hash, so the highest scores are a
    draw without replacement.  Of the N documents of ``min_words`` words or more,
    floor(percent * N / 100) are drawn and ranked from 1; the others' rank is null.  Equal
    scores go by id, null first, then by weight and features; rows equal in all of these
    are alike and take neighbouring ranks.  A null id is hashed as the empty string.
    """
    s = Scratch(docs.sparkSession, "resample")
    weighed = importance_weights(docs, target, id_col, text_col, target_text_col, n, buckets).withColumnRenamed(id_col, "id")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = s.table(weighed.withColumn("score", (F.col("weight") + noise).cast("long")))
    able = F.col("n_words") >= min_words
    order = (F.col("score").desc(), F.col("id").asc_nulls_first(), F.col("weight"), F.col("n_features"))
    # sorted over ranges; a row's place is its range's offset and its place in the range
    ranged = s.table(scored.filter(able).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    sizes = ranged.groupBy(F.shiftright("at", 33).cast("int").alias("range")).count().collect()  # one row a range
    offsets, total = [], 0
    for r in sorted(sizes, key=lambda r: r["range"]):
        offsets.append((r["range"], total))
        total += r["count"]
    starts = docs.sparkSession.createDataFrame(offsets, "range int, offset long")
    rank = F.col("offset") + F.col("at").bitwiseAND((1 << 33) - 1) + 1
    drawn = ranged.withColumn("range", F.shiftright("at", 33).cast("int")).join(F.broadcast(starts), "range").withColumn("rank", F.when(rank <= percent * total // 100, rank))
    kept = ["id", "n_words", "n_features", "weight", "score"]
    out = drawn.select(*kept, "rank").unionByName(scored.filter(~able).select(*kept, F.lit(None).cast("long").alias("rank")))
    return out.withColumnRenamed("id", id_col)
