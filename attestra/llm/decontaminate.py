"""Benchmark decontamination with a broadcast hash set of normalised n-grams.

The set is broadcast only while the benchmark's text is under a stated size.
Larger benchmarks go another way: document windows are shuffled to the benchmark's
windows by hash, and the hits return to their documents.  Both ways end in the same
exact comparison of words.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .bytespan import Rolling, Words, cover, mix, pieces, text_bytes
from ..scratch import Scratch

#: Bytes that part words: all of ASCII but digits and letters (A-Z are folded first).
GAPS = np.zeros(256, bool)
GAPS[:0x80] = True
GAPS[0x30:0x3A] = False
GAPS[0x61:0x7B] = False
_SPACED = bytes(0x20 if GAPS[b] else b for b in range(256))


def normal_words(text: bytes) -> list[bytes]:
    """The normalised words of a UTF-8 text."""
    return text.lower().translate(_SPACED).split()


def item_windows(words: list[bytes], n: int) -> list[bytes]:
    """Windows of n words; a shorter item that has words is one window."""
    return [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []


class NgramSet:
    """Hash sets by window length, with the items of each exact window."""

    def __init__(self, items: list[tuple[str, bytes]], n: int):
        self.names: list[str] = []
        self.items: dict[bytes, set[int]] = defaultdict(set)
        seen: dict[str, int] = {}
        for name, text in items:
            k = seen.setdefault(name, len(seen))
            for w in item_windows(normal_words(text), n):
                self.items[w].add(k)
        self.names = list(seen)
        by_len: dict[int, list[bytes]] = defaultdict(list)
        for w in self.items:
            by_len[w.count(b" ") + 1].append(w)
        self.hashes = {m: np.unique(_window_hashes(ws, m)) for m, ws in by_len.items()}

    def among(self, m: int, h: np.ndarray) -> np.ndarray:
        known = self.hashes[m]
        at = np.minimum(np.searchsorted(known, h), len(known) - 1)
        return known[at] == h


def _window_hashes(windows: list[bytes], m: int) -> np.ndarray:
    size = np.array([len(w) for w in windows], np.int64)
    ends = np.cumsum(size)
    w = Words(np.frombuffer(b"".join(windows), np.uint8), ends - size, ends, GAPS)
    return mix(Rolling(w.hash).windows(m)[w.first])


def _hit_mask(a: int, b: int, hits: list[tuple[int, int]]) -> np.ndarray:
    """Which of the words [a, b) lie in a hit (window length, first word)."""
    mask = np.zeros(b - a, bool)
    by: dict[int, list[int]] = defaultdict(list)
    for m, at in hits:
        by[m].append(at - a)
    for m, at in by.items():
        mask |= cover(np.array(at), m, b - a)
    return mask


def _clean(data: np.ndarray, words: Words, a: int, b: int, lo: int, begin: int, end: int, mask: np.ndarray) -> str:
    """The text without the spans from each first to last hit word of a run."""
    keep = np.ones(end - begin, bool)
    edge = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    for x, y in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1):
        keep[words.start[a + x] + lo - begin : words.stop[a + y] + lo - begin] = False
    return data[begin:end][keep].tobytes().decode("utf-8", "replace")


def _rows(ids: pa.Array, data, s, e, find, share: int, spans: bool, schema: pa.Schema, extra: list[pa.Array]) -> Iterator[pa.RecordBatch]:
    """Result rows of one batch, carried columns last; find(words, i) -> {text: (hits, item names)}."""
    cols: list[list] = [[] for _ in range(5 + spans)]
    for i, j in pieces(s, e):
        w = Words(data, s[i:j], e[i:j], GAPS, fold=True)
        lo = int(s[i])
        found = find(w, i)
        for t in range(j - i):
            a, b = int(w.first[t]), int(w.after[t])
            hits, names = found.get(t, ((), ()))
            mask = _hit_mask(a, b, hits) if hits else None
            n_hit = int(mask.sum()) if hits else 0
            row = [b - a, n_hit, len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), n_hit > 0 and share * n_hit >= b - a]
            if spans:
                row.append(_clean(data, w, a, b, lo, int(s[i + t]), int(e[i + t]), mask) if hits else data[s[i + t] : e[i + t]].tobytes().decode("utf-8", "replace"))
            for c, x in zip(cols, row):
                c.append(x)
    made = [ids, *(pa.array(c, schema.field(k + 1).type) for k, c in enumerate(cols))]
    yield pa.RecordBatch.from_arrays([*made, *extra], [*schema.names, *(f"_c{k}" for k in range(len(extra)))])


def _text(w: Words, at: int, m: int) -> bytes:
    return b" ".join(w.bytes[x:y].tobytes() for x, y in zip(w.start[at : at + m], w.stop[at : at + m]))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    n: int = 13,
    share: int = 20,
    clean_text: bool = False,
    max_broadcast_bytes: int = 4 << 20,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document row: id, n_words, n_hit, n_items, items_sha256, contaminated[, clean_text], carried columns.

    Words are the normalised ones of :func:`normal_words`.  A word inside any occurrence of
    a benchmark window is hit; a document is contaminated if it has a hit and ``share`` times
    its hits reach its words.  Null and empty texts have no words and are clean; items
    without words match nothing; a null item id counts as the empty string and repeated
    items count once.  Empty tables on either side give no rows, or clean rows.  With
    ``clean_text`` the text comes back without its hit spans.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    fields = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean" + ", clean_text string" * clean_text
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *(F.col(c).alias(f"_c{k}") for k, c in enumerate(carry)))
    carried = "".join(f", _c{k} {docs.schema[c].dataType.simpleString()}" for k, c in enumerate(carry))
    width = len(carry)
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + F.octet_length("item")), F.lit(0))).first()[0]
    names = ["id", *(f.split()[0] for f in fields.split(", "))]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string()]

    def schema_of(ids: pa.Array) -> pa.Schema:
        return pa.schema([pa.field(x, t) for x, t in zip(names, [ids.type, *types])])

    if total <= max_broadcast_bytes:
        held = docs.sparkSession.sparkContext.broadcast([(r.item, r.text.encode()) for r in items.collect()])

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grams = NgramSet(held.value, n)

            def find(w: Words, _: int) -> dict:
                out: dict = {}
                for m in grams.hashes:
                    h = mix(Rolling(w.hash).windows(m))
                    at = np.flatnonzero(grams.among(m, h) & w.fits(m)[: len(h)]) if len(h) else []
                    for x in at:
                        got = grams.items.get(_text(w, int(x), m))
                        if got:
                            hits, who = out.setdefault(int(w.text[x]), ([], set()))
                            hits.append((m, int(x)))
                            who.update(grams.names[k] for k in got)
                return out

            for b in batches:
                data, s, e = text_bytes(b.column(1))
                if len(s):
                    yield from _rows(b.column(0), data, s, e, find, share, clean_text, schema_of(b.column(0)), [b.column(2 + k) for k in range(width)])

        out = source.mapInArrow(scan, f"id {kind}, {fields}{carried}")
    else:
        out = _by_shuffle(source, items, kind, fields + carried, schema_of, n, share, clean_text, width)
    return out.withColumnsRenamed({"id": id_col} | {f"_c{k}": c for k, c in enumerate(carry)})


def _by_shuffle(source: DataFrame, items: DataFrame, kind: str, fields: str, schema_of, n: int, share: int, clean_text: bool, width: int) -> DataFrame:
    """The same rows with no broadcast: windows meet by hash, hits return by document."""
    s = Scratch(source.sparkSession, "decontaminate")

    def item_scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(w.count(b" ") + 1, w, name) for name, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for w in set(item_windows(normal_words(text.encode()), n))]
            by: dict[int, list] = defaultdict(list)
            for r in rows:
                by[r[0]].append(r)
            for m, rs in by.items():
                h = _window_hashes([r[1] for r in rs], m).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([m] * len(rs), pa.int32()), pa.array(h), pa.array([r[1] for r in rs], pa.binary()), pa.array([r[2] for r in rs], pa.string())], ["m", "h", "gram", "item"])

    grams = s.table(items.mapInArrow(item_scan, "m int, h long, gram binary, item string").distinct())
    sizes = [r[0] for r in grams.select("m").distinct().collect()]

    def doc_scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, st, en = text_bytes(b.column(1))
            for i, j in pieces(st, en):
                w = Words(data, st[i:j], en[i:j], GAPS, fold=True)
                for m in sizes:
                    h = mix(Rolling(w.hash).windows(m))
                    at = np.flatnonzero(w.fits(m)[: len(h)]) if len(h) else np.zeros(0, np.int64)
                    if len(at):
                        t = w.text[at]
                        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(i + t)), pa.array(np.full(len(at), m, np.int32)), pa.array(h[at].view(np.int64)), pa.array((at - w.first[t]).astype(np.int32))], ["id", "m", "h", "at"])

    hits = source.select("id", "text").mapInArrow(doc_scan, f"id {kind}, m int, h long, at int").join(grams, ["m", "h"])
    hits = s.table(hits.groupBy("id").agg(F.collect_set(F.struct("m", "at", "gram", "item")).alias("hits")))
    ready = source.join(hits, source["id"].eqNullSafe(hits["id"]), "left").select(source["id"], "text", "hits", *(source[f"_c{k}"] for k in range(width)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, st, en = text_bytes(b.column(1))
            given = b.column(2).to_pylist()

            def find(w: Words, i: int, given=given) -> dict:
                out: dict = {}
                for t in range(len(w.first)):
                    for x in given[i + t] or ():
                        at = int(w.first[t]) + x["at"]
                        if at + x["m"] <= w.after[t] and _text(w, at, x["m"]) == x["gram"]:
                            got, who = out.setdefault(t, ([], set()))
                            got.append((x["m"], at))
                            who.add(x["item"])
                return out

            if len(st):
                yield from _rows(b.column(0), data, st, en, find, share, clean_text, schema_of(b.column(0)), [b.column(3 + k) for k in range(width)])

    return ready.mapInArrow(scan, f"id {kind}, {fields}")
