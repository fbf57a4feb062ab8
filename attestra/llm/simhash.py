"""SimHash near-duplicates over a byte-position inverted index with count filtering.

A 64-bit fingerprint has eight positional bytes.  Two fingerprints that differ in
at most ``bits`` bits share at least ``8 - bits`` of them, the guaranteed minimum
``m``.  The index therefore posts each distinct fingerprint under every choice of
``m`` positions with its bytes there; a pair is tallied (how many positional bytes
it shares), kept if the tally reaches ``m``, taken only from the posting of its
first ``m`` shared positions, and verified by its differing bits.

Single-byte postings would pair N * N / 256 fingerprints at each position; with four
bytes a posting holds one of 2**32 values, so lists stay short until N nears 2**32.
Lists that are long hold one family of close copies.  In those, members within
``bits // 2`` of a pivot form a ball (all its members link through the pivot), and only
balls that can reach each other are compared: links between all members are
implied, not listed.

A posting of more than ``long_posting`` fingerprints streams through its task and is posted
again by half-bytes: of the eight that its key leaves open, members that link share at least
four as well, so each choice of four is a posting of its own with 16 open bits, and
no posting is held with more than 65,536 members however many copies there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytespan import text_bytes
from .names import free_name
from ..components import connected_components
from ..scratch import Scratch

#: Postings up to this many fingerprints are paired member by member.
SHORT = 24


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """The fingerprint of one UTF-8 text; a text without words has zero."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        h = np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    else:
        begin = [0, *accumulate(len(w) + 1 for w in words)]
        digest = xxhash.xxh64_intdigest
        stops = begin[shingle:]
        h = np.fromiter((digest(joined[a : b - 1], seed) for a, b in zip(begin, stops)), np.uint64, n - shingle + 1)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 65536):
        ones += np.unpackbits(h[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """One row per document: its id and ``fp``, the fingerprint's bits as a long.

    Null and empty texts, and texts without words, have fingerprint zero.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, s, e = text_bytes(b.column(1))
            out = np.fromiter((fingerprint(data[i:j].tobytes(), shingle, seed) for i, j in zip(s, e)), np.uint64, len(s))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out.view(np.int64))], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string")).mapInArrow(scan, f"id {kind}, fp long")


def _star(v: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join exactly what links join among distinct fingerprints v, far fewer than the links."""
    near, rest = bits // 2, v
    pivots, balls, out = [], [], []
    while len(rest):
        close = np.bitwise_count(rest ^ rest[0]) <= near
        pivots.append(rest[0])
        balls.append(rest[close])
        rest = rest[~close]
    p = np.array(pivots, np.uint64)
    root = np.arange(len(p))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    maybe: list[tuple[int, np.ndarray]] = []
    for i in range(len(p)):
        out.append((np.full(len(balls[i]), p[i]), balls[i]))
        d = np.bitwise_count(p[i + 1 :] ^ p[i])
        for j in i + 1 + np.flatnonzero(d <= bits):
            if (a := find(i)) != (b := find(j)):
                root[b] = a
                out.append((p[i : i + 1], p[j : j + 1]))
        maybe.append((i, (i + 1 + np.flatnonzero((d > bits) & (d <= bits + 2 * near))).astype(np.int32)))
    for i, js in maybe:
        for j in js:
            if (a := find(i)) != (b := find(j)):
                for x in balls[i]:
                    hit = np.flatnonzero(np.bitwise_count(balls[j] ^ x) <= bits)
                    if len(hit):
                        root[b] = a
                        out.append((np.array([x]), balls[j][hit[:1]]))
                        break
    return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])


def _pairs(choice: np.ndarray, v: np.ndarray, run: np.ndarray, masks: np.ndarray, bits: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified pairs of the short postings; run numbers the postings."""
    left, right = [], []
    for d in range(1, SHORT):
        if d >= len(v):
            break
        i = np.flatnonzero(run[d:] == run[:-d])
        if not len(i):
            break
        x = v[i] ^ v[i + d]
        shared = x.view(np.uint8).reshape(-1, 8) == 0
        tally = shared.cumsum(1)
        first = (shared & (tally <= least)) @ (1 << np.arange(8))
        keep = (tally[:, -1] >= least) & (first == masks[choice[i]]) & (np.bitwise_count(x) <= bits)
        left.append(v[i[keep]])
        right.append(v[i[keep] + d])
    return (np.concatenate(left), np.concatenate(right)) if left else (v[:0], v[:0])


def _half_bytes(choice: tuple[int, ...], bits: int) -> list[np.uint64]:
    """Masks of a posting's own bytes with each choice of ``bits`` half-bytes: of 2 * bits open ones at most ``bits`` differ."""
    own = sum(0xFF << (8 * p) for p in choice)
    open_ = [4 * k for p in range(8) if p not in choice for k in (2 * p, 2 * p + 1)]
    return [np.uint64(own | sum(0xF << at for at in c)) for c in combinations(open_, bits)]


def link_edges(fps: DataFrame, s: Scratch, bits: int = 4, long_posting: int = 1 << 14) -> DataFrame:
    """distinct fingerprints (fp) -> (a, b): edges that connect exactly what links at ``bits`` bits connect."""
    least = 8 - bits
    if least < 1:
        raise ValueError("bits must be under 8 for a byte index")
    choices = list(combinations(range(8), least))
    masks = np.array([sum(1 << p for p in c) for c in choices])
    as_long = [int(np.array(sum(0xFF << (8 * p) for p in c), np.uint64).view(np.int64)) for c in choices]

    def edges(limit: int | None) -> Callable:
        """Postings in key order -> edges (c < 0, a, b), and members of postings over the limit (c, k, a)."""

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def rows(c: np.ndarray, k: np.ndarray, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)), *(pa.array(x.view(np.int64)) for x in (k, a, b))], ["c", "k", "a", "b"])

            def done(c: np.ndarray, k: np.ndarray, v: np.ndarray) -> Iterator[pa.RecordBatch]:
                """Whole postings only."""
                cut = np.flatnonzero((c[1:] != c[:-1]) | (k[1:] != k[:-1])) + 1
                begin = np.concatenate([[0], cut])
                size = np.diff(np.concatenate([begin, [len(v)]]))
                run = np.repeat(np.arange(len(begin)), size)
                short = (size[run] > 1) & (size[run] <= SHORT)
                found = [_pairs(c[short], v[short], run[short], masks, bits, least)] if limit else [_star(np.unique(v[b : b + n]), bits) for b, n in zip(begin, size) if 1 < n <= SHORT]
                found += [_star(np.unique(v[b : b + n]), bits) for b, n in zip(begin[size > SHORT], size[size > SHORT]) if not limit or n <= limit]
                if found:
                    a, b = (np.concatenate(x) for x in zip(*found))
                    yield from rows(np.full(len(a), -1), np.zeros(len(a), np.int64), a, b)
                if limit:
                    far = size[run] > limit
                    yield from rows(c[far], k[far], v[far], v[far])

            held: list[tuple] = []
            streams = False  # whether the posting that is open is over the limit, its members on their way
            for batch in batches:
                c, k, v = (np.asarray(batch.column(i)) for i in range(3))
                if not len(c):
                    continue
                v = v.view(np.uint64)
                last = np.flatnonzero((c != c[-1]) | (k != k[-1]))
                at = int(last[-1]) + 1 if len(last) else 0
                ahead = held and (held[-1][0][-1] != c[0] or held[-1][1][-1] != k[0])
                if streams and not ahead:  # the rest of the long posting
                    n = int(np.flatnonzero((c != c[0]) | (k != k[0]))[0]) if at else len(c)
                    yield from rows(c[:n], k[:n], v[:n], v[:n])
                    if n == len(c):
                        continue
                    c, k, v, at = c[n:], k[n:], v[n:], at - n
                    held, streams = [], False
                elif streams:
                    held, streams = [], False
                if at or ahead:
                    held.append((c[:at], k[:at], v[:at]))
                    yield from done(*(np.concatenate(x) for x in zip(*held)))
                    held = []
                held.append((c[at:], k[at:], v[at:]))
                if limit and sum(len(x[0]) for x in held) > limit:
                    c, k, v = (np.concatenate(x) for x in zip(*held))
                    yield from rows(c, k, v, v)
                    held, streams = [(c[-1:], k[-1:], v[-1:])], True
            if held and not streams:
                yield from done(*(np.concatenate(x) for x in zip(*held)))

        return scan

    posted = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in as_long])).alias("c", "k"))
    ordered = posted.select(F.col("c").cast("int"), "k", "fp").repartition("c", "k").sortWithinPartitions("c", "k")
    shape = "c int, k long, a long, b long"
    found = s.table(ordered.mapInArrow(edges(long_posting), shape))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c, v = np.asarray(batch.column(0)), np.asarray(batch.column(1)).view(np.uint64)
            for one in np.unique(c):
                mine = v[c == one]
                for n, mask in enumerate(_half_bytes(choices[one], bits)):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(mine), one * 4096 + n, np.int32)), pa.array((mine & mask).view(np.int64)), pa.array(mine.view(np.int64))], ["c", "k", "fp"])

    narrow = found.filter("c >= 0").select("c", "a").mapInArrow(again, "c int, k long, fp long").repartition("c", "k").sortWithinPartitions("c", "k")
    near = narrow.mapInArrow(edges(None), shape)
    return found.filter("c < 0").select("a", "b").unionByName(near.select("a", "b")).distinct()


def _named(found: DataFrame, s: Scratch, bits: int) -> DataFrame:
    """(fp, root) of every distinct fingerprint of ``found``, root the smallest fingerprint reached."""
    fps = s.table(found.select("fp").distinct())
    roots = connected_components(link_edges(fps, s, bits), s)
    return fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 4, shingle: int = 4) -> DataFrame:
    """One row per document row: (id_col, fingerprint hex, component_id).

    component_id is the smallest id reachable over links of at most ``bits`` differing
    bits; null ids are passed over while another is in reach.  Null, empty and wordless texts
    share fingerprint zero and link like others.  Repeated rows repeat in the result.  An
    empty table gives no rows.  Only the id and text columns are read, so further columns
    cannot clash.
    """
    s = Scratch(docs.sparkSession, "simhash")
    found = s.table(fingerprints(docs, id_col, text_col, shingle))
    reps = found.groupBy("fp").agg(F.min("id").alias("rep"))
    joined = s.table(_named(found, s, bits).join(reps, "fp"))  # written, so that the join can split a component of very many fingerprints
    least = s.table(joined.groupBy("root").agg(F.min("rep").alias("component_id")))
    named = s.table(joined.join(least, "root").select("fp", "component_id"))
    out = found.join(named, "fp", "left")
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 4, shingle: int = 4) -> DataFrame:
    """The rows of ``docs``, all columns, less all but one row of each component of :func:`simhash_components`.

    The row with the smallest id stays, null last; of several with that id the one with the smallest
    hash of its text, then of all its columns; of equal rows one.  Columns that cannot be hashed (maps)
    do not enter the last hash.
    """
    s = Scratch(docs.sparkSession, "simhash")
    hashable = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    names = list(docs.columns)
    u, w, number = (free_name(n, names) for n in ("row_hash", "row_hash_2", "row_number"))
    rows = docs.withColumns({u: F.xxhash64(*hashable), w: F.xxhash64(F.lit(1), *hashable)})
    text = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    key = F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("id"), text.alias("v"), F.col(u).alias("u"), F.col(w).alias("w"))
    found = s.table(fingerprints(rows.select(key.alias("key"), F.col(text_col).alias("text")), "key", "text", shingle).withColumnRenamed("id", "key"))
    first = found.groupBy("fp").agg(F.min("key").alias("key"))
    joined = s.table(_named(found, s, bits).join(first, "fp"))
    stays = s.table(joined.groupBy("root").agg(F.min("key").alias("key")).select(F.col("key.u").alias(u), F.col("key.w").alias(w)))
    # rows meet by 128 bits of hash of all their columns; the window reuses the join's partitions
    kept = rows.join(stays, [u, w], "left_semi")
    return kept.withColumn(number, F.row_number().over(Window.partitionBy(u, w).orderBy(u))).filter(F.col(number) == 1).select(*(F.col(f"`{n}`") for n in names))
