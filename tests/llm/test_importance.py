"""Importance resampling against a plain count of every feature."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from attestra.llm import importance

from . import brute

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, n):
    w = WORD.findall(brute.ascii_lower(text))
    return len(w), [" ".join(w[i : i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def plain(docs, target, n=2, buckets=10_000, percent=25, min_words=20):
    bucket = lambda x: zlib.crc32(x.encode()) % buckets
    rows = [(i, *features(t, n)) for i, t in docs]
    s = Counter(bucket(x) for r in rows for x in r[2])
    t = Counter(bucket(x) for text in target for x in features(text, n)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    out = []
    for i, words, xs in rows:
        weight = sum(gain[bucket(x)] for x in xs) // len(xs) if xs else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, words, len(xs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], -1 if r[0] is None else r[0], r[3], r[2]))
    for place, r in enumerate(able):
        r.append(place + 1 if place < percent * len(able) // 100 else None)
    return Counter(tuple(r) if len(r) == 6 else (*r, None) for r in out)


def got(df):
    return Counter((r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect())


@pytest.mark.parametrize("n", [1, 2, 3])
def test_against_plain_counts(spark, n, monkeypatch):
    rows = brute.corpus(n) + [(100, "One. TWO, two-two é É ß " * 30), (100, "other text " * 15), (None, "no id here " * 20), (101, None), (102, "--- ..."), (103, "x" * 5000 + " y")]
    rows += [(200 + i, "the same copy of a text " * 8) for i in range(40)] + [(300, "twice " * 25)] * 2
    target = ["The same copy", None, "", "one two é É " * 3]
    for piece, slot, common in ((1 << 23, 1 << 22, 512), (700, 900, 3)):
        monkeypatch.setattr(importance, "PIECE", piece)
        monkeypatch.setattr(importance, "SLOT", slot)
        monkeypatch.setattr(importance, "COMMON", common)
        df = spark.createDataFrame([(i, t, 1, 2, 3, 4) for i, t in rows], "doc_id long, text string, id int, weight int, score int, piece int").repartition(3)
        aim = spark.createDataFrame([(t,) for t in target], "text string")
        assert got(importance.resample(df, aim, n=n)) == plain(rows, target, n)


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert importance.resample(none, some).count() == 0
    assert got(importance.resample(some, none)) == plain([(1, "a b c")], [])


def test_crc_of_spans():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, 5000, dtype=np.uint8)
    start = rng.integers(0, 2000, 300)
    stop = start + rng.integers(0, 600, 300)
    assert importance.crc32_spans(data, start, stop).tolist() == [zlib.crc32(data[a:b]) for a, b in zip(start, stop)]


def test_strings_of_one_hash_keep_their_own_buckets(monkeypatch):
    words = [b"aa", b"bb", b"aa", b"cc"]
    length = np.array([2] * 4)
    real = importance.chained
    monkeypatch.setattr(importance, "chained", lambda d, a, b, seed: np.zeros(len(a), np.uint64) if seed == importance.BASE_B else real(d, a, b, seed))
    found = importance._buckets_of(np.frombuffer(b"".join(words), np.uint8), length, 1000)
    assert found.tolist() == [zlib.crc32(w) % 1000 for w in words]
