"""Each pipeline stage against brute force, on small tables with nulls, repeats, ties and clashing columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from attestra.llm import docstats, quality, rules, toxicity

from . import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators give their results or use inside.
CLASH = ("n_removed", "n_words", "n_bytes", "n_spans", "kept_sha256", "kept", "n_hit", "n_items", "items_sha256", "contaminated", "_s", "_l", "n_tokens", "Mix_topic", "fp", "key", "id", "v", "row_hash", "_c0", "score", "text_")


def rows_of(corpus):
    return [(i, t, ["en", "de", None][k % 3], f"s{k % 2}", len(t or "")) for k, (i, t) in enumerate(corpus)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sf")
    base = brute.corpus(11, 40)
    long = " ".join(f"word{k}" for k in range(30_000))
    corpus = base + [(None, "a null id " + "x y " * 60), (None, "another null id " + "p q " * 60), (5, base[7][1]), (6, base[6][1]), (6, base[6][1]), (70, long), (71, long + " tail")]
    rows = rows_of(corpus)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for c in CLASH:
        df = df.withColumn(c, F.lit(f"my {c}"))
    labels = [(i, int(k % 3 > 0), int(k % 4 == 0)) for k, (i, _) in enumerate(base)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    bench = [("b1", " ".join(brute.words(base[13][1])[9:40])), ("b2", None), ("b3", "ab ab")]
    spark.createDataFrame(bench, "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    df.write.parquet(f"{folder}/documents.parquet")
    return rows, df, str(folder), bench, labels


def same_columns(out, df):
    assert out.columns == df.columns
    clash = out.select(*CLASH).distinct().collect()
    assert not clash or [tuple(r) for r in clash] == [tuple(f"my {c}" for c in CLASH)]


def plain(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


def test_quality(spark, tables):
    rows, df, folder, _, labels = tables
    out = corpus_pipeline.quality(spark, df, folder)
    same_columns(out, df)
    known = {i: q for i, q, _ in labels}
    model = plain_discriminant([(t, known[i]) for i, t, *_ in rows if i in known and brute.crc(i) % 5 != 0])
    want = [(r[0], r[1]) for r in rows if model(r[1]) >= 0.3]
    assert plain(out) == sorted(want, key=repr)
    assert corpus_pipeline.quality(spark, df.limit(0), folder).count() == 0


def features(t):
    data = np.frombuffer((t or "").encode(), np.uint8)
    return docstats.statistics(data, np.array([0]), np.array([len(data)]))[0]


def plain_discriminant(train, to_pooled=0.2, to_identity=0.02):
    """The discriminant by determinants and inverses of whole matrices, calibrated by plain gradient steps."""
    x, y = np.array([features(t) for t, _ in train]), np.array([q for _, q in train])
    cov = [np.cov(x[y == k].T, bias=True) for k in (0, 1)]
    pooled = sum((y == k).mean() * cov[k] for k in (0, 1))
    mean, inverse, log_det = [], [], []
    for k in (0, 1):
        c = (1 - to_pooled) * cov[k] + to_pooled * pooled
        c = (1 - to_identity) * c + to_identity * (np.trace(c) / len(c) + 1e-6) * np.eye(len(c))
        mean.append(x[y == k].mean(0))
        inverse.append(np.linalg.inv(c))
        log_det.append(np.linalg.slogdet(c)[1])

    def difference(z):
        log = [-0.5 * ((z - mean[k]) @ inverse[k] @ (z - mean[k]) + log_det[k]) for k in (0, 1)]
        return float(np.clip(log[1] - log[0], -quality.RANGE, quality.RANGE))

    width = 2 * quality.RANGE / quality.BINS
    d = np.array([(np.floor((difference(z) + quality.RANGE) / width) + 0.5) * width - quality.RANGE for z in x])
    slope, offset = quality._logistic(d, y.astype(float), np.ones(len(d)))
    return lambda t: 1 / (1 + np.exp(-(slope * difference(features(t)) + offset)))


def test_near_duplicates(spark, tables):
    rows, df, folder, _, _ = tables
    out = corpus_pipeline.near_duplicates(spark, df, folder)
    same_columns(out, df)
    fps = [brute.fingerprint(t) for _, t, *_ in rows]
    groups = {}
    for r, g in zip(rows, brute.components(fps, 4)):
        groups.setdefault(g, []).append(r)
    got = out.select("doc_id", "text").collect()
    assert len(got) == len(groups)
    for members in groups.values():
        ids = [m[0] for m in members if m[0] is not None]
        texts = {m[1] for m in members if m[0] == (min(ids) if ids else None)}
        assert sum(r.doc_id == (min(ids) if ids else None) and r.text in texts for r in got) >= 1
    assert corpus_pipeline.near_duplicates(spark, df.limit(0), folder).count() == 0


def test_repeated_strings(spark, tables):
    rows, df, folder, _, _ = tables
    own = [r for r in rows if r[0] is not None and r[0] > 6] + [(None, "n" * 300, None, None, 300)]
    few = df.filter("doc_id > 6").unionByName(df.limit(1).select(F.lit(None).cast("long").alias("doc_id"), F.lit("n" * 300).alias("text"), *(c for c in df.columns if c not in ("doc_id", "text"))))
    out = corpus_pipeline.repeated_strings(spark, few, folder)
    same_columns(out, df)
    ordered = sorted(own, key=lambda r: -1 if r[0] is None else r[0])
    seqs = [(r[1] or "").encode() for r in ordered]
    want = []
    for r, s, cut in zip(ordered, seqs, brute.repeats(seqs, 100)):
        want.append((r[0], bytes(b for b, x in zip(s, cut) if not x).decode("utf-8", "ignore")))
    assert plain(out) == sorted(want, key=repr)
    assert all(r.n_chars == len(r.text) for r in out.select("n_chars", "text").collect())


def test_decontaminate(spark, tables):
    rows, df, folder, bench, _ = tables
    out = corpus_pipeline.decontaminate(spark, df, folder)
    same_columns(out, df)
    numbered = [(k, r[1]) for k, r in enumerate(rows)]
    bad = {k for k, x in brute.contamination(numbered, bench).items() if x[4]}
    assert bad and plain(out) == sorted(((r[0], r[1]) for k, r in enumerate(rows) if k not in bad), key=repr)


def test_mixture(spark, tables):
    rows, df, folder, _, _ = tables
    out = corpus_pipeline.mixture(spark, df, folder)
    assert out.columns[: len(df.columns)] == df.columns
    kept = {(r.doc_id, r.text) for r in out.collect()}
    assert kept <= {(r[0], r[1]) for r in rows} and all(brute.words(t) for _, t in kept)
    seen = out.select("n_tokens_", "text", "mix_probability").collect()
    assert all(r.n_tokens_ == len(brute.words(r.text)) and 0 < r.mix_probability <= 1 for r in seen)


def test_run(spark, tables):
    _, df, folder, _, _ = tables
    out = corpus_pipeline.run(spark, folder)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_strings", "decontaminate", "mixture"]
    assert set(df.columns) <= set(out.columns) and 0 <= out.count() <= df.count()


def test_rules_kept_by_plain_conditions(spark):
    rng = np.random.default_rng(12)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        words = ["".join(rng.choice(list("abcdefgh"), 5)) + ("##" if bad and rng.random() < 0.6 else "") for _ in range(80)]
        rows.append((i, " ".join(words)))
        labels.append((i, int(not bad)))
    rows += [(900, None), (901, ""), (902, " ".join(["a b c"] * 40)), (None, rows[0][1]), (0, rows[0][1])]
    out = rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    listed = sorted({r.rule for r in out if r.rule})
    assert listed
    text = {}
    for i, t in rows:
        text.setdefault(i, t)

    def holds(rule, t):
        w = brute.words(t)
        n, chars, symbols, dup, rep, _ = brute.base_statistics(t)
        lines = [x for x in (t or "").split("\n") if brute.words(x)]
        have = {"words": n, "word_length": chars / max(n, 1), "symbols_per_word": symbols / max(n, 1), "upper_share": sum("A" <= c <= "Z" for c in t or "") / max(chars, 1), "bangs_per_word": (t or "").count("!") / max(n, 1), "repeated_words": rep / max(n, 1), "repeated_lines": dup / max(len(lines), 1), "distinct_words": len(set(w)) / max(n, 1)}
        return all((have[name] > float(cut)) if op == ">" else (have[name] <= float(cut)) for name, op, cut in (c.split() for c in rule.split(" and ")))

    assert len(out) == len(rows)
    for r in out:
        t = text[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.base_statistics(t)
        fires = [rule for rule in listed if holds(rule, t)]
        assert bool(fires) == (r.rule is not None) and r.kept == (not r.base_failed and not fires)


def test_noisy_or_of_sentences_by_hand(spark):
    """A document's score from its sentences' scores, and a sentence's from its words."""
    model = toxicity.NoisyOr(np.sort(np.array([1, 2], np.uint64)), np.array([2.0, 1.0]), -3.0, 0.01)
    text = b"Good words here. Bad words there! And the rest"
    s = toxicity.Sentences(np.frombuffer(text, np.uint8), np.array([0]), np.array([len(text)]))
    h, where = toxicity._tokens(s)
    model.vocabulary = np.sort(np.array([h[1], h[3]], np.uint64))  # "words", in the first two sentences, and "bad" in the second
    p = model.of_sentences(s)
    weight = dict(zip(model.vocabulary.tolist(), model.weight.tolist()))
    want = []
    for k in range(len(s.text)):
        z = -3.0 + sum(weight[x] for x in set(h[where == k].tolist()) if x in weight)
        want.append(1 / (1 + np.exp(-z)))
    assert np.allclose(p, want) and len(p) == 3
    assert np.allclose(model.of_texts(s, p, 1), 1 - (1 - 0.01) * np.prod([1 - x for x in want]))


def test_rows_past_the_sample_do_not_fit(spark):
    rows = [(i, ("vile " if i % 3 == 0 else "") + f"w{i} some words. more") for i in range(300)] + [(None, "vile"), (1, "vile again"), (1, "vile again")]
    labels = [(i, int(i % 3 == 0)) for i in range(300)]
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    small = toxicity.toxicity_scores(docs, known, max_rows=60).collect()
    assert len(small) == len(rows) and all(0 <= r.score <= 1 for r in small)
    assert len({r.score for r in small if r.doc_id == 1}) == 2  # rows of one id by their own texts
