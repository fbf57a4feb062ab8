"""One-letter pairs against all pairs, and absorption against the list gone through one by one."""

import random

import pytest

from attestra import numbering
from attestra.operators import variants

PARTY = "party_key string, canonical_name string, normalized_name string, mention_count long, name_variants array<string>"


def apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_pairs_one_letter_apart(spark):
    rng = random.Random(1)
    names = {"".join(rng.choice("ab c") for _ in range(rng.randrange(0, 6))) for _ in range(250)} | {"x", ""}
    df = spark.createDataFrame([(n,) for n in [*names, *list(names)[:9]]] + [(None,)], "n string")
    got = sorted((r.a, r.b) for r in variants.one_edit_pairs(df, "n").collect())
    assert got == sorted((a, b) for a in names for b in names if a < b and apart(a, b))


def greedy(parties, ratio, kept):
    order = sorted(parties, key=lambda p: (-p[3], p[0]))
    count, spelt, words = {p[0]: p[3] for p in parties}, {p[0]: set(p[4]) for p in parties}, {p[0]: set(p[2].split()) for p in parties}
    gone, out = {}, []
    for i, r in enumerate(order):
        for c in order[:i]:
            if c[0] in gone or frozenset((r[0], c[0])) in kept or r[3] * ratio > count[c[0]]:
                continue
            if min(len(r[2]), len(c[2])) >= 6 and apart(r[2], c[2]):
                why = variants.ONE_EDIT
            elif words[r[0]] and words[r[0]] < words[c[0]] and sum(words[r[0]] < w for k, w in words.items() if k != r[0]) == 1:
                why = variants.FRAGMENT
            else:
                continue
            out.append((r[0], r[3], c[0], count[c[0]], round(count[c[0]] / max(r[3], 1), 1), why))
            gone[r[0]] = c[0]
            spelt[c[0]] |= spelt[r[0]]
            count[c[0]] += r[3]
            break
    return sorted(out), sorted((p[0], count[p[0]], sorted(spelt[p[0]])) for p in parties if p[0] not in gone)


@pytest.mark.parametrize("ratio", [1.5, 4])
def test_absorbed_as_one_by_one(spark, ratio):
    rng = random.Random(ratio)
    base = [" ".join("".join(rng.choice("mnor") for _ in range(rng.randrange(3, 6))) for _ in range(rng.randrange(1, 4))) for _ in range(60)]
    names = list(base)
    while len(names) < 2000:
        n = rng.choice(base if rng.random() < 0.5 else names)
        kind = rng.random()
        if kind < 0.6:
            i = rng.randrange(len(n))
            n = n[:i] + rng.choice("mnor") + n[i + rng.randrange(2) :]
        elif kind < 0.8:
            n = " ".join(rng.sample(n.split(), max(1, len(n.split()) - 1)))
        names.append(" ".join(n.split()))
    parties = [(f"k{i:04}", n.title(), n, rng.choice([1, 1, 1, 2, 3, 5, 8, 13, 40, 90]), [n.title(), f"v{i % 7}"]) for i, n in enumerate(names)]
    kept = {frozenset(rng.sample([p[0] for p in parties], 2)) for _ in range(3000)}
    left, moved = variants.absorb_variants(spark.createDataFrame(parties, PARTY), ratio, spark.createDataFrame([tuple(k) for k in kept], "a string, b string"))
    out, stay = greedy(parties, ratio, kept)
    assert sorted((r.absorbed_party_key, r.absorbed_mentions, r.surviving_party_key, r.surviving_mentions, r.mention_ratio, r.reason) for r in moved.collect()) == out
    assert sorted((r.party_key, r.mention_count, r.name_variants) for r in left.collect()) == stay
    assert {o[5] for o in out} == {variants.ONE_EDIT, variants.FRAGMENT}


def test_nothing_to_absorb(spark):
    one = spark.createDataFrame([("k", "A", "alpha beta", 3, ["A"])], PARTY)
    for df, ratio in ((one, 2), (one, 0), (one.limit(0), 2)):
        left, moved = variants.absorb_variants(df, ratio)
        assert moved.count() == 0 and left.count() == df.count()


def test_common_words_are_not_gathered(spark, monkeypatch):
    monkeypatch.setattr(variants, "COMMON", 3)
    rng = random.Random(5)
    names = [f"customer {i}" for i in range(40)] + [" ".join(rng.sample(["customer", "north", "oak", "elm", "bay"], rng.randrange(1, 4))) for _ in range(60)] + ["customer 7 oak"]
    words = [set(n.split()) for n in names]
    holders = {n: [m for m, w in zip(names, words) if set(n.split()) < w] for n in names}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    held = variants.sole_holders(df, "n")
    assert sorted((r.fragment, r.whole) for r in held.collect()) == sorted({(n, m[0]) for n, m in holders.items() if len(m) == 1})
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 4


def test_pairs_are_dealt_by_letters(spark, monkeypatch):
    monkeypatch.setattr(numbering, "TASK_ROWS", 100)
    df = spark.createDataFrame([(f"customer {i}",) for i in range(200)], "n string")
    pairs = variants.one_edit_pairs(df, "n")
    assert "RepartitionByExpression" in pairs._jdf.queryExecution().optimizedPlan().toString()
    assert pairs.count() == len({(a, b) for a in range(200) for b in range(a) if apart(str(a), str(b))})
