"""The conversation trie against a plain dictionary of prefixes."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np

from attestra.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()


def conversations(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append(((turn is not None, turn or 0), digest(role, text), role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in by.items()}


def family(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def nodes(convs):
    members = defaultdict(list)
    for c, path in convs.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)

    def under(p):
        yield p
        for q in kids[p]:
            yield from under(q)

    out = Counter()
    for p, cs in members.items():
        below = list(under(p))
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        ends = ",".join(map(str, sorted(c for c in cs if len(convs[c]) == len(p))))
        out[(min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(kids[p]), sum(not kids[q] for q in below), saved, hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


def got(df):
    return Counter((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def invented(seed=0, n=60):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        if c % 11 == 3:
            continue  # families without their first conversation too
        for t in range(int(rng.integers(1, 14))):
            rows.append((c, t, ["user", "assistant", None, ""][int(rng.integers(0, 4))], ["hé", "b", None, "", "common"][int(rng.integers(0, 5))] if t > 1 else "opening"))
    rows += [(200 + i, t, "user", f"copy {t}") for i in range(30) for t in range(12)]
    rows += [(300, None, "user", "null turn"), (300, 2, "user", "tie a"), (300, 2, "user", "tie b"), (300, 2, "user", "tie b"), (None, 0, "user", "no conversation"), (1_000_000, 0, "user", "long " * 2000)]
    rows += [(302, t, "user", "x") for t in range(200)]
    return rows


def test_family_against_plain_prefixes(spark, monkeypatch):
    for pack in (4096, 3):
        monkeypatch.setattr(trie, "PACK", pack)
        rows = invented()
        df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA + ", conv int, depth int, key int").repartition(3)
        assert got(trie.family_trie(df)) == nodes(family(conversations(rows)))


def test_conversations_as_they_are(spark):
    rows = invented(1, 40)
    assert got(trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == nodes(conversations(rows))


def test_no_conversation_and_one(spark):
    assert trie.family_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(7, 0, None, None)]
    assert got(trie.family_trie(spark.createDataFrame(rows, SCHEMA))) == nodes(family(conversations(rows)))
