"""Substring deduplication over words with fixed-block anchors.

Every document is a reference: its words are cut in non-overlapping blocks of
``length // 2`` words, and the blocks are indexed.  A window of ``length`` words always
holds a whole block of any document it also occurs in, so every rolling window of
block size probes the index.  A hit elsewhere than at itself is extended: the full
windows around it are named by all their words, the earliest place of each name stays,
and removed windows that touch run together to the maximal exact repeats.  A name is two
64-bit hashes, of words hashed by two independent seeds.

Probes are as many as words, so they go through the shuffle in ``rounds`` slices of the
hash space, each written down before the next; the slices only bound the disk in use.
Repeats inside one Arrow batch are settled there, so the windows of one name
that meet in a task are at most as many as batches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytespan import BASE_A, BASE_B, Rolling, U, Words, cover, mix, pieces, text_bytes
from .grouping import lists_by_document, order_key, same_group, starts
from ..scratch import Scratch
from .suffix import _documents, _long, _taken, finish, with_spans

PIECE = 1 << 20


def _blocks(words: Words, size: int, every: int, part: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of the windows of ``size`` words at multiples of ``every``, in one slice of the hashes."""
    h = mix(Rolling(words.hash).windows(size))
    if not len(h):
        return h, np.zeros(0, np.int64)
    ok = words.fits(size)[: len(h)]
    if every > 1:
        ok &= (np.arange(len(h)) - words.first[words.text[: len(h)]]) % every == 0
    if parts > 1:
        ok &= (h >> U(40)) % U(parts) == U(part)
    at = np.flatnonzero(ok)
    return h[at], at


def _scan_blocks(documents: DataFrame, kind: str, size: int, every: int, part: int, parts: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, s, e = text_bytes(b.column(2))
            for i, j in pieces(s, e, PIECE):
                w = Words(data, s[i:j], e[i:j])
                h, at = _blocks(w, size, every, part, parts)
                if len(at):
                    t = w.text[at]
                    yield _taken(b, i + t, ["h", "at"], _long(h), pa.array((at - w.first[t]).astype(np.int32)))

    return documents.mapInArrow(scan, f"id {kind}, v long, h long, at int")


def _hits(documents: DataFrame, s: Scratch, kind: str, size: int, rounds: int) -> DataFrame:
    """(id, v, at): lists of the word places whose block-sized window is an indexed block elsewhere."""
    found = None
    for part in range(rounds):
        index = _scan_blocks(documents, kind, size, size, part, rounds).groupBy("h").agg(F.min("id").alias("fid"), F.min("at").alias("fat"), F.count("*").alias("c"))
        index = s.table(index)  # written, so that the join deals both sides itself and can split a hot block
        probes = _scan_blocks(documents, kind, size, 1, part, rounds)
        # a block that is indexed once is no hit at its own place
        hit = probes.join(index.hint("shuffle_hash"), "h").filter(~((F.col("c") == 1) & F.col("id").eqNullSafe(F.col("fid")) & (F.col("at") == F.col("fat"))))
        hit = s.table(lists_by_document(hit, ("at",)))
        s.drop(index)
        found = hit if found is None else found.unionByName(hit)
    return found.groupBy("id", "v").agg(F.flatten(F.collect_list("at")).alias("at"))


def _earliest_stay(named: DataFrame, kind: str) -> DataFrame:
    """(id, v, at): of the windows (w1, w2, id, v, at, later) those marked later, and those with an earlier namesake.

    Windows of one name stream through in the order of their places; the first stays.
    Rows of one id stand at the same place.
    """
    name, place = ("later", "w1", "w2"), ("id", "at")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = None  # (batch, row) of the first window of the name that is open
        for b in batches:
            if not b.num_rows:
                continue
            new = starts(b, name)
            if first is not None and same_group(*first, b, 0, name):
                new[0] = False
            at = np.maximum.accumulate(np.where(new, np.arange(b.num_rows), -1))
            later = np.asarray(b.column("later"))
            own = starts(b, (*name, *place))  # rows at the place of the first stay with it
            run = np.maximum.accumulate(np.where(own, np.arange(b.num_rows), 0))
            gone = later | ((at >= 0) & (run > at))
            if at[0] < 0:
                for i in np.flatnonzero((at < 0) & own):
                    gone[i] = later[i] or not same_group(*first, b, int(i), place)
                gone[at < 0] = gone[run[at < 0]]
            if new.any():
                first = (b, int(at[-1]))
            pick = pa.array(np.flatnonzero(gone))
            yield pa.RecordBatch.from_arrays([b.column(c).take(pick) for c in ("id", "v", "at")], ["id", "v", "at"])

    dealt = named.repartition("w1").sortWithinPartitions("later", "w1", "w2", "id", "at")
    return dealt.mapInArrow(scan, f"id {kind}, v long, at int")


def _again(w1: np.ndarray, w2: np.ndarray, place: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which windows have an equal name at an earlier (place, at)."""
    order = np.lexsort((at, place, w2, w1))
    a, z = order[1:], order[:-1]
    new = np.ones(len(order), bool)
    new[1:] = (w1[a] != w1[z]) | (w2[a] != w2[z])
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    out = np.zeros(len(order), bool)
    out[order] = (place[order] != place[first]) | (at[order] != at[first])
    return out


def _removed(documents: DataFrame, s: Scratch, kind: str, length: int, rounds: int) -> DataFrame:
    """(id, v, at): lists of the windows of ``length`` words that also start earlier."""
    size = length // 2
    hits = s.table(_hits(documents, s, kind, size, rounds))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, st, en = text_bytes(b.column(2))
            lists = b.column(3)
            row = np.repeat(np.arange(len(st)), np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64))
            hit = np.asarray(lists.flatten()).astype(np.int64)
            cols: list[list] = [[] for _ in range(4)]
            for i, j in pieces(st, en, PIECE):
                w = Words(data, st[i:j], en[i:j])
                pick = (row >= i) & (row < j)
                n = len(w.start)
                if n < length or not pick.any():
                    continue
                x = w.first[row[pick] - i] + hit[pick]
                near = cover(np.maximum(x - (length - size), 0), length - size + 1, n)[: n - length + 1]
                at = np.flatnonzero(near & w.fits(length)[: n - length + 1])
                for c, y in zip(cols, (Rolling(w.hash, BASE_A).windows(length)[at], Rolling(w.second, BASE_B).windows(length)[at], i + w.text[at], at - w.first[w.text[at]])):
                    c.append(y)
            if not cols[0]:
                continue
            w1, w2, t, at = (np.concatenate(c) for c in cols)
            w1, w2 = mix(w1), mix(w2)
            # of one name in this batch only the earliest place goes on; the others are settled, and dealt out evenly
            later = _again(w1, w2, order_key(b.column(0))[t], at)
            w1[later] = mix(w1[later] + t[later].astype(np.uint64) * U(BASE_B) + at[later].astype(np.uint64))
            yield _taken(b, t, ["w1", "w2", "at", "later"], _long(w1), _long(w2), pa.array(at.astype(np.int32)), pa.array(later))

    named = with_spans(documents, hits, "inner").mapInArrow(scan, f"id {kind}, v long, w1 long, w2 long, at int, later boolean")
    gone = s.table(_earliest_stay(named, kind))
    s.drop(hits)
    return lists_by_document(gone, ("at",))


def remove_repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 20,
    rounds: int = 2,
    keep_text: bool = False,
) -> DataFrame:
    """One row per document row: (id_col, n_words, n_removed, kept_sha256[, kept]).

    A word goes if a window of ``length`` words covers it that also starts earlier: in a
    document with a smaller id, or earlier in its own; windows are judged on the input.
    ``kept`` holds the remaining words joined by one space.  Null and empty texts have no
    words.  Rows with one id stand at the same place and do not remove each other's
    equal places; a null id comes first.  An empty table gives no rows.
    """
    documents = _documents(docs, id_col, text_col)
    kind = documents.schema["id"].dataType.simpleString()
    s = Scratch(docs.sparkSession, "fixedblocks")
    gone = _removed(documents, s, kind, length, rounds)

    def rest(data: np.ndarray, st: np.ndarray, en: np.ndarray, row: np.ndarray, fields: list[np.ndarray]) -> Iterator[tuple]:
        at = fields[0]
        left, right = np.searchsorted(row, np.arange(len(st))), np.searchsorted(row, np.arange(len(st)), "right")
        for k in range(len(st)):
            words = data[st[k] : en[k]].tobytes().split()
            n = 0
            if left[k] < right[k]:
                hit = cover(at[left[k] : right[k]], length, len(words))
                n = int(hit.sum())
                kept = b" ".join(w for w, x in zip(words, hit.tolist()) if not x)
            else:
                kept = b" ".join(words)
            yield len(words), n, hashlib.sha256(kept).hexdigest(), kept.decode() if keep_text else None

    return finish(documents, gone, rest, kind, ["n_words long", "n_removed long", "kept_sha256 string"] + ["kept string"] * keep_text).withColumnRenamed("id", id_col)
