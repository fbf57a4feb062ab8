"""The dealt operators against brute force, with nulls, ties, repeated rows, empty tables and clashing columns."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from attestra.llm import bytespan, decontaminate, fixedblocks, mixing, quality, rules, simhash, suffix, toxicity, urltree, warc
from attestra.components import connected_components
from attestra.scratch import Scratch

from . import brute

SCHEMA = "doc_id long, text string"
CLASH = "id long, v long, h long, at int, text_ string, fp long"


@pytest.fixture(scope="module")
def docs(spark):
    rows = brute.corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for c in CLASH.split(", "):
        df = df.withColumn(c.split()[0], F.lit(1).cast(c.split()[1]))
    return rows, df


def table(df, key="doc_id"):
    out = {}
    for r in df.collect():
        d = r.asDict()
        k = d.pop(key)
        out[k] = tuple(d.values())
    return out


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_passages(spark, docs):
    rows, df = docs
    assert table(fixedblocks.remove_repeated_passages(df)) == brute.passages(rows)
    assert fixedblocks.remove_repeated_passages(empty(spark)).count() == 0


def test_strings(spark, docs):
    rows, df = docs
    assert table(suffix.remove_repeats(df)) == brute.strings(rows)
    assert suffix.remove_repeats(empty(spark)).count() == 0


def test_long_text_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(1)
    t = "".join(rng.choice(list("abcdefgh"), 6000))
    rows = [(0, t), (1, t[500:3500] + "zz" + t[3600:])]
    data, s, e = bytespan.text_bytes(spark.createDataFrame(rows, SCHEMA).toArrow().column("text"))
    monkeypatch.setattr(suffix, "BLOCK", 500)
    got = [(int(t), int(a), int(n)) for x in suffix.anchors(data, s, e, 100, 20) for t, a, n in zip(x[0], x[3], x[4])]
    covered = sorted((t, a + k) for t, a, n in got for k in range(n))
    assert covered == [(t, p) for t, r in enumerate(rows) for p in range(len(r[1]) - 99)]


def test_repeated_ids_with_other_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    df = spark.createDataFrame([(1, a), (1, b), (1, a), (2, a + " " + b)], SCHEMA)
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in fixedblocks.remove_repeated_passages(df).collect())
    assert got == [(1, 40, 0), (1, 40, 0), (1, 40, 0), (2, 80, 80)]
    got = sorted((r.doc_id, r.n_removed) for r in suffix.remove_repeats(df).collect())
    assert got[:3] == [(1, 0)] * 3 and got[3][1] == len(a + b)


def thue_morse(n, a, b):
    return "".join(b if i.bit_count() % 2 else a for i in range(n))


def test_words_that_a_power_sum_cannot_tell_apart(spark):
    rest = " ".join(f"w{i}" for i in range(19))
    for n in (64, 255, 256, 257, 1024, 4096):
        rows = [(1, thue_morse(n, "a", "b") + " " + rest), (2, thue_morse(n, "b", "a") + " " + rest)]
        got = table(fixedblocks.remove_repeated_passages(spark.createDataFrame(rows, SCHEMA)))
        assert got == brute.passages(rows) and got[2][1] == 0
    rows = [(i, thue_morse(4096, *x)) for i, x in enumerate(("ab", "ba"))]
    assert table(suffix.remove_repeats(spark.createDataFrame(rows, SCHEMA))) == brute.strings(rows)


def test_one_rank_over_many_ranges(spark):
    rng = np.random.default_rng(4)
    noise = lambda m: "".join(rng.choice(list("abcdefghijklmnop"), m))
    common = noise(34)
    rows = [(i, noise(90) + common + noise(90)) for i in range(300)]
    rows += [(300 + i, rows[7 * i][1][20:150] + noise(60)) for i in range(20)] + [(400, rows[3][1] + rows[4][1])]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert table(suffix.remove_repeats(df)) == brute.strings(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_simhash(spark, docs):
    rows, df = docs
    fps = [brute.fingerprint(t) for _, t in rows]
    want = {i: (f"{f:016x}", rows[r][0]) for (i, _), f, r in zip(rows, fps, brute.components(fps, 4))}
    assert table(simhash.simhash_components(df)) == want
    assert simhash.simhash_components(empty(spark)).count() == 0


def test_link_edges_of_dense_and_sparse_fingerprints(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 40, dtype=np.int64)
    fps = set(map(int, base))
    for b in base[:2]:
        for _ in range(150):
            f = int(b)
            for bit in rng.integers(0, 63, rng.integers(1, 7)):
                f ^= 1 << int(bit)
            fps.add(f)
    fps = sorted(fps)
    want = brute.components(fps, 4)
    for long_posting in (1 << 14, 40, 2):  # all in one task, and long postings posted again
        edges = simhash.link_edges(spark.createDataFrame([(f,) for f in fps], "fp long"), Scratch(spark, "test"), long_posting=long_posting)
        assert all((r.a ^ r.b).bit_count() <= 4 for r in edges.collect())
        roots = {r.node: r.root for r in connected_components(edges, Scratch(spark, "test")).collect()}
        assert [roots.get(f, f) for f in fps] == [fps[r] for r in want]


@pytest.mark.parametrize("limit", [4 << 20, 0])
def test_contamination(spark, limit):
    rows = brute.corpus(3)
    passage = " ".join(brute.words(rows[3][1])[9:69])
    items = [(1, passage), (2, "ab ab"), (3, None), (4, "!!"), (12, passage[:120]), (1, passage)]
    df = spark.createDataFrame(rows + [(100, passage.upper()), (101, passage.replace(" ", "-\n"))], SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = table(decontaminate.contamination(df, bench, max_broadcast_bytes=limit))
    assert got == brute.contamination(rows + [(100, passage.upper()), (101, passage.replace(" ", "-\n"))], items)
    assert not any(r.contaminated for r in decontaminate.contamination(df, bench.limit(0)).collect())
    assert decontaminate.contamination(empty(spark), bench).count() == 0


def test_clean_text_and_carried_columns(spark):
    df = spark.createDataFrame([(1, "before one two three after", "x")], "doc_id long, text string, id string")
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    r = decontaminate.contamination(df, bench, clean_text=True, carry=("id", "text")).first()
    assert r.clean_text == "before  after" and r.id == "x" and r.text.startswith("before one")


def labelled(n=600, seed=2):
    rng = np.random.default_rng(seed)
    vocab = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        w = list(rng.choice(vocab, 120))
        bad, toxic = rng.random() < 0.25, rng.random() < 0.25
        if bad:
            w = [x + "$$$" for x in w]
        if toxic:
            w[int(rng.integers(0, 100))] = str(rng.choice(["vile", "awful"]))
        rows.append((i, ". ".join(" ".join(w[k : k + 10]) for k in range(0, 120, 10)) + "."))
        labels.append((i, int(not bad), int(toxic)))
    rows += [(n, None), (n + 1, ""), (n + 2, "...")]
    return rows, labels


@pytest.fixture(scope="module")
def known(spark):
    rows, labels = labelled()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("x", F.lit("clash")).withColumn("y", F.lit(1))
    return rows, labels, df, spark.createDataFrame([*labels, (0, None, None), labels[1]], "doc_id long, quality int, toxic int")


def accuracy(out, labels, k):
    got = {r.doc_id: r for r in out.collect()}
    held = [x for x in labels if got[x[0]].held_out]
    assert len(held) > 50 and all(0 <= r.score <= 1 for r in got.values())
    return sum(got[x[0]].predicted == x[k] for x in held) / len(held)


def test_quality(spark, known):
    rows, labels, df, lab = known
    out = quality.quality_scores(df, lab)
    assert out.count() == len(rows) and accuracy(out, labels, 1) > 0.97
    none = quality.quality_scores(df, lab.limit(0))
    assert {r.score for r in none.collect()} == {0.5}
    assert quality.quality_scores(empty(spark), lab).count() == 0
    kept = {r.doc_id for r in quality.keep_quality(df, lab).collect()}
    assert kept == {r.doc_id for r in out.collect() if r.score >= 0.3}


def test_toxicity(spark, known):
    rows, labels, df, lab = known
    out = toxicity.toxicity_scores(df, lab)
    assert out.count() == len(rows) and accuracy(out, labels, 2) > 0.95
    found = toxicity.offending_sentences(df, lab)
    assert found.count() > 50 and all("vile" in r.span or "awful" in r.span for r in found.collect())
    assert toxicity.toxicity_scores(empty(spark), lab).count() == 0
    assert toxicity.toxicity_scores(df, lab.limit(0)).count() == len(rows)


def test_rule_statistics_and_list(spark, known):
    sample = brute.corpus(7)
    got = {r.id: tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for r in rules.text_statistics(spark.createDataFrame(sample, SCHEMA)).collect()}
    assert got == {i: brute.base_statistics(t)[:5] for i, t in sample}
    rows, labels, df, lab = known
    out = {r.doc_id: r for r in rules.quality_rules(df, lab).collect()}
    assert all(out[i].kept == bool(q) for i, q, _ in labels) and not out[len(labels)].kept
    assert any("symbols_per_word" in (r.rule or "") for r in out.values())
    assert all(r.kept != r.base_failed for r in rules.quality_rules(df, lab.limit(0)).collect())
    assert rules.quality_rules(empty(spark), lab).count() == 0


def test_mixing(spark):
    rows = [(i, "w " * (1 + i % 7), "a" if i % 3 else "b", "en" if i % 2 else None) for i in range(3000)] + [(9000, None, "a", "en"), (9001, "w", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("w", F.lit(1)).withColumn("_s", F.lit("kept")).withColumn("N_tokens", F.lit(5))
    out = mixing.mix(df, targets={"source": {"a": 0.5, "b": 0.5, "": 0.0}}, budget=0.3)
    got = out.groupBy("source").agg(F.sum("n_tokens_").alias("n")).collect()
    n = {r.source: r.n for r in got}
    assert abs(n["a"] / (n["a"] + n["b"]) - 0.5) < 0.06 and 9000 not in {r.doc_id for r in out.select("doc_id").collect()}
    assert {(r._s, r.N_tokens) for r in out.select("_s", "N_tokens").collect()} == {("kept", 5)}
    assert mixing.mix(df.limit(0)).count() == 0


def test_mixing_is_calibrated(spark):
    rng = np.random.default_rng(9)
    rows = [(i, "w " * int(rng.integers(1, 60)) + str(rng.choice(["", "", "", "", "@", "!"])), str(rng.choice(list("aaaaabbc"))), str(rng.choice(["en", "en", "de"]))) for i in range(8000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    cells = {}
    for r in mixing.mixing_report(df, budget=0.5).collect():
        cells.setdefault(r.axis, {})[r.value] = (r.tokens, r.kept, r.share)
    for axis, values in cells.items():
        total = sum(t for t, _, _ in values.values())
        root = {v: (t / total) ** 0.5 for v, (t, _, _) in values.items()}
        wanted = {v: x / sum(root.values()) for v, x in root.items()}
        assert abs(sum(k for _, k, _ in values.values()) / total - 0.5) < 1e-9
        # a value is at its target, or at all of its tokens
        scale = [k / (wanted[v] * total / 2) for v, (t, k, _) in values.items() if k < t * (1 - 1e-9)]
        assert scale and max(scale) - min(scale) < 1e-6 and min(scale) >= 1 - 1e-9
        assert all(k <= t * (1 + 1e-9) for t, k, _ in values.values())
    out = mixing.mix(df, budget=0.5)
    assert abs(out.agg(F.sum("n_tokens")).first()[0] / sum(len(r[1].split()) for r in rows) - 0.5) < 0.02


def test_mixing_on_the_driver_and_by_tables(spark):
    rows = [(i, "w " * (1 + i % 7) + "@" * (i % 5 == 0), "abc"[i % 3 * (i % 4 > 0)], "en" if i % 2 else None) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    some = {"targets": {"lang": {"en": 0.7, "": 0.3}}, "budget": 0.6}
    both = [sorted((r.doc_id, r.mix_probability, round(r.mix_weight, 9)) for r in mixing.mix(df, max_cells=m, **some).collect()) for m in (1, 50_000)]
    assert both[0] == both[1] and len(both[0]) > 100


def test_warc_round_trip(spark):
    big = "<p>ä</p>" * 9000
    pages = [(1, "http://a/", big), (2, "http://b/\r\n", big), (3, None, None), (4, "c", "x" * 999), (5, "d", "x" * 999), (6, "e", "y" * 1000), (7, "f", "y" * 1000), (7, "f", "y" * 1000), (8, "g", "WARC/1.1\r\n\r\n\r\n\r\n0\r\n\r\n")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("row", F.lit(1))
    got = sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.status) for r in warc.round_trip(df, segment_bytes=5000, chunk_bytes=700).collect())
    size = lambda h: len((h or "").encode())
    sha = lambda h: hashlib.sha1((h or "").encode()).hexdigest()
    refers = {1: 2, 6: 7}
    assert got == sorted((i, size(h), sha(h), "revisit" if i in refers else "response", refers.get(i), "ok") for i, _, h in pages)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_warc_payloads_and_faults(spark):
    s = Scratch(spark, "warc-test")
    html = "".join(chr(97 + i % 26) for i in range(20000))
    df = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    warc.write_archives(df, f"{s.root}/a", segment_bytes=4096)
    assert warc.read_archives(spark, f"{s.root}/a", with_payload=True).first().payload == html.encode()
    lines = spark.read.text(f"{s.root}/a", wholetext=True)
    broken = lines.select(F.regexp_replace("value", "WARC-Segment-Number: 3", "WARC-Segment-Number: 9"))
    broken.write.option("compression", "gzip").text(f"{s.root}/b")
    assert warc.read_archives(spark, f"{s.root}/b").first().status == "missing_segment"
    for broken in (b"5\r\nabc", b"-1\r\nabc\r\n0\r\n\r\n", b"\r\nabc", b"3\r\nabc\r\n0\r\n", b"3\r\nabc\r\n0\r\nx"):
        with pytest.raises(ValueError):
            warc.dechunked(broken)
    assert warc.dechunked(b"3;x=1\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"


def test_urls(spark):
    urls = [None, "no scheme", "http://A.Example.COM/en/1?q#f", "https://www.example.com/en/2", "http://x.net/es/1", "http://net/fr/", "http://notexample.com/x", "http://b.org?x/y", "http://x.net/", "ftp://h.org/a b#c"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urltree.url_verdicts(df.withColumn("n", F.lit(1)).withColumn("host", F.lit("clash"))).collect()}
    assert got == {
        0: ("", "", None, "allow"),
        1: ("", "", None, "allow"),
        2: ("a.example.com", "/en/1", "example.com/en/", "block"),
        3: ("www.example.com", "/en/2", "www.example.com/en/", "allow"),
        4: ("x.net", "/es/1", "net/es/", "block"),
        5: ("net", "/fr/", "net/fr/", "block"),
        6: ("notexample.com", "/x", "com/", "allow"),
        7: ("b.org", "", None, "allow"),
        8: ("x.net", "/", None, "allow"),
        9: ("h.org", "/a b", None, "allow"),
    }
    assert urltree.url_verdicts(df.limit(0)).count() == 0


def test_url_templates_reject_by_purity(spark):
    rows = [(i, f"http://h.org/{'bad' if i % 2 else 'good'}/{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    out = urltree.url_verdicts(df.filter("page_id < 400"), rules=(("block", "h.org", "/bad/1"), ("allow", "h.org", "/good/")))
    v = {r.page_id: (r.verdict, r.template) for r in out.collect()}
    assert all(x == ("block", "/bad/*") for k, x in v.items() if k % 2) and all(x[0] == "allow" for k, x in v.items() if not k % 2)
