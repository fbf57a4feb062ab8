"""Toxicity by multiple-instance learning: sentences are the instances, documents carry the labels.

A sentence's probability is a logistic function of the words it holds; a document's is
the noisy-or of its sentences, 1 - prod(1 - p).  Only document labels exist, so the
likelihood of the noisy-or is climbed directly: the gradient hands a document's label
to its sentences by their responsibility.  Words and their stems enter as 64-bit hashes; those
that tell the classes apart in document counts are the vocabulary.

The fit reads a bounded sample of labelled rows (``max_rows``); scoring reads all of
every text.  The same scores locate the offending sentences.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .bytespan import Rolling, U, Words, byte_symbols, mix, pieces, text_bytes
from .decontaminate import GAPS

#: A word longer than so many bytes also enters by its beginning.
STEMS = (5, 6, 7)
_END = np.zeros(256, bool)
_END[list(b".!?\n")] = True


class Sentences:
    """The normalised words of texts and the sentence each is in; a sentence ends at . ! ? or a line feed."""

    def __init__(self, data: np.ndarray, s: np.ndarray, e: np.ndarray):
        w = self.words = Words(data, s, e, GAPS, fold=True)
        n = len(w.start)
        ends = np.concatenate([[0], np.cumsum(_END[w.bytes])])
        new = np.ones(n, bool)
        new[1:] = (ends[w.start[1:]] > ends[w.start[:-1]]) | (w.text[1:] != w.text[:-1])
        self.of_word = np.cumsum(new) - 1
        self.first_word = np.flatnonzero(new)
        self.text = w.text[self.first_word]

    def stops(self) -> np.ndarray:
        """After the last word of each sentence."""
        return np.append(self.first_word[1:], len(self.words.start))


@dataclass
class NoisyOr:
    """Word weights, the sentence intercept, and each document's leak."""

    vocabulary: np.ndarray  # sorted hashes
    weight: np.ndarray
    intercept: float
    leak: float  # of a document, whatever its sentences

    def hits(self, s: Sentences) -> np.ndarray:
        """Distinct (sentence, vocabulary word), in sentence order."""
        if not len(self.vocabulary) or not len(s.text):
            return np.zeros((0, 2), np.int64)
        h, where = _tokens(s)
        at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        hit = np.flatnonzero(self.vocabulary[at] == h)
        return np.stack(np.divmod(np.unique(where[hit] * len(self.vocabulary) + at[hit]), len(self.vocabulary)), 1)

    def of_sentences(self, s: Sentences) -> np.ndarray:
        """Each sentence's probability."""
        z = np.full(len(s.text), self.intercept)
        once = self.hits(s)
        np.add.at(z, once[:, 0], self.weight[once[:, 1]])
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def of_texts(self, s: Sentences, p: np.ndarray, n: int) -> np.ndarray:
        clean = np.bincount(s.text, np.log1p(-np.minimum(p, 1 - 1e-12)), n) if len(p) else np.zeros(n)
        return 1 - (1 - self.leak) * np.exp(clean)


def _tokens(s: Sentences) -> tuple[np.ndarray, np.ndarray]:
    """(hash, sentence): of every word, and of the first 5, 6 and 7 bytes of longer ones."""
    w = s.words
    roll = Rolling(byte_symbols(w.bytes))
    hashes, where = [w.hash], [s.of_word]
    for k in STEMS:
        long = np.flatnonzero(w.stop - w.start > k)
        hashes.append(mix(roll.spans(w.start[long], w.start[long] + k) + U(k)))
        where.append(s.of_word[long])
    return np.concatenate(hashes), np.concatenate(where)


def _vocabulary(rows: DataFrame, size: int, least: int, z_least: float) -> tuple[np.ndarray, float, float]:
    """(sorted hashes of the tokens that lean to label 1 the most by document counts, rows, rows of label 1).

    Tokens are counted once a document, first within a batch and then by Spark.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, s, e = text_bytes(b.column(0))
            y = np.asarray(b.column(1))
            for i, j in pieces(s, e):
                x = Sentences(data, s[i:j], e[i:j])
                h, where = _tokens(x)
                if not len(h):
                    continue
                doc = x.text[where]
                order = np.lexsort((doc, h))
                h, doc = h[order], doc[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                h, doc = h[new], doc[new]
                begin = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
                n, pos = np.diff(np.append(begin, len(h))), np.add.reduceat(y[i:j][doc].astype(np.int64), begin)
                yield pa.RecordBatch.from_arrays([pa.array(h[begin].view(np.int64)), pa.array(n.astype(np.int64)), pa.array(pos)], ["h", "n", "pos"])

    n_rows, n_pos = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not 0 < n_pos < n_rows:
        return np.zeros(0, np.uint64), n_rows, n_pos
    base = n_pos / n_rows
    counted = rows.select("text", "y").mapInArrow(count, "h long, n long, pos long").groupBy("h").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    z = (F.col("pos") - F.col("n") * base) / F.sqrt(F.col("n") * (base * (1 - base)))
    best = counted.filter(F.col("pos") >= least).withColumn("z", z).filter(F.col("z") > z_least).orderBy(F.desc("z"), "h").limit(size)
    return np.sort(np.array([r.h for r in best.select("h").collect()], np.int64).view(np.uint64)), n_rows, n_pos


def _train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str,
    text_col: str,
    label_col: str,
    folds: int,
    fold: int,
    max_rows: int,
    size: int = 2048,
    least: int = 4,
    z_least: float = 4.0,
) -> NoisyOr:
    """Fit on at most ``max_rows`` labelled rows outside the held-out fold, the first by a hash of the id."""
    text_id = F.coalesce(F.col("id").cast("string"), F.lit(""))
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    known = known.filter(F.pmod(F.crc32(text_id.cast("binary")), F.lit(folds)) != fold)
    some = known.orderBy(F.xxhash64(text_id), "id").limit(max_rows)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).join(F.broadcast(some), "id").select("text", "y")
    vocabulary, n_rows, n_pos = _vocabulary(rows, size, least, z_least)
    if not len(vocabulary):
        return NoisyOr(vocabulary, np.zeros(0), -20.0, float((n_pos + 1) / (n_rows + 2)))
    probe = NoisyOr(vocabulary, np.zeros(len(vocabulary)), 0.0, 0.0)

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each document its label, its sentences, and (sentence, vocabulary word) of those that hold one."""
        for b in batches:
            data, s, e = text_bytes(b.column(0))
            for i, j in pieces(s, e):
                x = Sentences(data, s[i:j], e[i:j])
                once = probe.hits(x)
                doc = x.text[once[:, 0]]
                offsets = pa.array(np.searchsorted(doc, np.arange(j - i + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(once[:, k].astype(np.int32))) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([b.column(1).slice(i, j - i), pa.array(np.bincount(x.text, minlength=j - i).astype(np.int32)), *lists], ["y", "n", "s", "w"])

    got = rows.mapInArrow(bags, "y int, n int, s array<int>, w array<int>").toArrow().combine_chunks()
    sizes = np.asarray(got.column("s").combine_chunks().value_lengths()).astype(np.int64)
    flat = [np.asarray(got.column(c).combine_chunks().flatten()).astype(np.int64) for c in ("s", "w")]
    return fit(vocabulary, np.asarray(got.column("y")).astype(float), np.asarray(got.column("n")).astype(np.int64), np.repeat(np.arange(len(sizes)), sizes), *flat)


def fit(vocabulary: np.ndarray, y: np.ndarray, sentences: np.ndarray, doc: np.ndarray, sentence: np.ndarray, word: np.ndarray, steps: int = 400, ridge: float = 2e-4) -> NoisyOr:
    """Climb the noisy-or likelihood of document labels by Adam: y and sentences by document; (doc, sentence, word) of the hits."""
    pair, row = np.unique(doc * (int(sentences.max(initial=0)) + 1_000_000) + sentence, return_inverse=True)
    owner = pair // (int(sentences.max(initial=0)) + 1_000_000)  # the document of each sentence with a hit
    plain = sentences - np.bincount(owner, minlength=len(y))  # sentences without
    theta = np.concatenate([np.full(len(vocabulary), 0.5), [-5.0, -4.0]])  # weights, intercept, leak
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        w, b, c = theta[:-2], theta[-2], theta[-1]
        p = 1 / (1 + np.exp(-np.clip(b + np.bincount(row, w[word], len(pair)), -30, 30)))
        p0, leak = 1 / (1 + np.exp(-b)), 1 / (1 + np.exp(-c))
        log_clean = np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-9)), len(y)) + plain * np.log1p(-p0) + np.log1p(-leak)
        clean = np.exp(log_clean)
        pull = np.where(y == 1, clean / np.maximum(1 - clean, 1e-9), -1.0)  # d log L / d z of an instance is pull * p
        instance = pull[owner] * p
        g = np.zeros_like(theta)
        g[:-2] = np.bincount(word, instance[row], len(vocabulary))
        g[-2] = instance.sum() + (pull * plain).sum() * p0
        g[-1] = pull.sum() * leak
        g = -g / len(y)
        g[:-2] += ridge * theta[:-2]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta -= 0.08 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return NoisyOr(vocabulary, theta[:-2], float(theta[-2]), float(1 / (1 + np.exp(-theta[-1]))))


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    folds: int = 4,
    held_out_fold: int = 2,
    threshold: float = 0.3,
    max_rows: int = 12_000,
) -> DataFrame:
    """One row per document row: (id_col, held_out, score, predicted, n_sentences, worst_sentence, worst_score).

    The last three locate the worst sentence: its number from 0 (null without sentences)
    and its own probability.  Null and empty texts have no sentences and score the
    leak.  Trains outside crc32(id as text) mod ``folds`` = ``held_out_fold``; a null id
    counts as the empty text and is unlabelled; labels other than 0 and 1 are ignored, of
    several for one id the largest holds.  Without both labels the score is constant.
    """
    ship(docs.sparkSession)
    model = _train(docs, labels, id_col, text_col, label_col, folds, held_out_fold, max_rows)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, s, e = text_bytes(b.column(1))
            out: list[list] = [[], [], [], []]
            for i, j in pieces(s, e):
                x = Sentences(data, s[i:j], e[i:j])
                p = model.of_sentences(x)
                n = j - i
                count = np.bincount(x.text, minlength=n)
                first = np.cumsum(count) - count
                order = np.lexsort((np.arange(len(p)), -p, x.text))
                worst = np.full(n, -1)
                have = count > 0
                worst[have] = order[first[have]]
                score = np.where(have, p[worst] if len(p) else 0.0, 0.0)
                for c, v in zip(out, (model.of_texts(x, p, n), count, np.where(have, worst - first, -1), score)):
                    c.append(v)
            if out[0]:
                score, count, worst, top = (np.concatenate(c) for c in out)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score), pa.array(count.astype(np.int64)), pa.array(worst.astype(np.int64), mask=worst < 0), pa.array(top)], ["id", "score", "n_sentences", "worst_sentence", "worst_score"])

    kind = docs.schema[id_col].dataType.simpleString()
    scored = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string")).mapInArrow(scan, f"id {kind}, score double, n_sentences long, worst_sentence long, worst_score double")
    fold = F.pmod(F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")), F.lit(folds))
    return scored.select(F.col("id").alias(id_col), (fold == held_out_fold).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_sentences", "worst_sentence", "worst_score")


def offending_sentences(docs: DataFrame, labels: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = 12_000) -> DataFrame:
    """(id_col, sentence, begin, end, score, span): every sentence of at least ``least``, from its first to its last word, in byte places."""
    ship(docs.sparkSession)
    model = _train(docs, labels, id_col, text_col, label_col, 4, 2, max_rows)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, s, e = text_bytes(b.column(1))
            for i, j in pieces(s, e):
                x = Sentences(data, s[i:j], e[i:j])
                p = model.of_sentences(x)
                count = np.bincount(x.text, minlength=j - i)
                hit = np.flatnonzero(p >= least)
                if not len(hit):
                    continue
                begin, end = x.words.start[x.first_word[hit]] + s[i], x.words.stop[x.stops()[hit] - 1] + s[i]
                t = x.text[hit]
                number = hit - (np.cumsum(count) - count)[t]
                span = [data[u:v].tobytes().decode("utf-8", "replace") for u, v in zip(begin, end)]
                cols = [number, begin - s[i:j][t], end - s[i:j][t]]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(i + t)), *(pa.array(c.astype(np.int64)) for c in cols), pa.array(p[hit]), pa.array(span)], ["id", "sentence", "begin", "end", "score", "span"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string")).mapInArrow(scan, f"id {kind}, sentence long, begin long, end long, score double, span string")
    return out.withColumnRenamed("id", id_col)
