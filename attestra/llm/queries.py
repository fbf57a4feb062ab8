"""The digest queries of the training-data operators, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encode_documents
from .decontaminate import contamination
from .importance import resample
from .mixing import mix, mixing_sql
from .fixedblocks import remove_repeated_passages
from .quality import quality_scores
from .rules import quality_rules
from .simhash import simhash_components
from .suffix import remove_repeats
from .toxicity import toxicity_scores
from .trie import family_trie
from .urltree import url_verdicts
from .warc import round_trip


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fixed_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_passages(_read(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_read(spark, sf_dir, "pages"))


#: Parameters of the mixing query, shared with its SQL.
MIX = {"power": 0.5, "budget": 0.5, "rounds": 500, "seed": "mix"}


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(_read(spark, sf_dir, "documents"), **MIX)
    return out.select("doc_id", "n_tokens", "mix_topic", F.round("mix_weight", 9).alias("mix_weight"), "mix_probability")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_read(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(_read(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op10_url_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(_read(spark, sf_dir, "pages"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return family_trie(_read(spark, sf_dir, "conversations"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_fixed_blocks, op2_warc, op3_mixing, op4_quality_rules, op5_quality, op6_suffix_array, op7_simhash, op8_decontaminate, op9_toxicity, op10_url_tree, op11_importance, op12_trie, op13_bpe)}

_WORDS8 = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

def _crc(strings: str) -> str:
    """CTEs that end in crc(s, c): the unsigned crc32 of each distinct s of the table ``strings``."""
    return f"""
tab AS (SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(i)),
steps AS (SELECT s, hex(encode(s)) AS x, 0 AS k, CAST(4294967295 AS BIGINT) AS c FROM (SELECT DISTINCT s FROM {strings})
          UNION ALL SELECT s, x, k + 1, xor(c >> 8, v) FROM steps JOIN tab ON i = xor(c, CAST('0x' || substr(x, 2 * k + 1, 2) AS BIGINT)) & 255 WHERE 2 * k < length(x)),
crc AS (SELECT s, xor(c, 4294967295) AS c FROM steps WHERE 2 * k = length(x))"""


SQL: dict[str, str] = {
    "op11_importance": rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS8} AS w FROM documents),
b AS (SELECT {_WORDS8} AS w FROM benchmark),
f AS (SELECT doc_id, s, count(*) AS n FROM (
        SELECT doc_id, unnest(w) AS s FROM d UNION ALL SELECT doc_id, w[i] || ' ' || w[i + 1] FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM d)) GROUP BY ALL),
g AS (SELECT s, count(*) AS n FROM (
        SELECT unnest(w) AS s FROM b UNION ALL SELECT w[i] || ' ' || w[i + 1] FROM (SELECT w, unnest(range(1, len(w))) AS i FROM b)) GROUP BY ALL),
strings AS (SELECT s FROM f UNION SELECT s FROM g),{_crc("strings")},
src AS (SELECT c % 10000 AS k, sum(n) AS n FROM f JOIN crc USING (s) GROUP BY ALL),
aim AS (SELECT c % 10000 AS k, sum(n) AS n FROM g JOIN crc USING (s) GROUP BY ALL),
tot AS (SELECT (SELECT coalesce(sum(n), 0) FROM src) AS big_s, (SELECT coalesce(sum(n), 0) FROM aim) AS big_t),
gain AS (SELECT src.k, floor(1000 * ln(CAST((coalesce(aim.n, 0) + 1) * (big_s + 10000) AS DOUBLE) / CAST((src.n + 1) * (big_t + 10000) AS DOUBLE))) AS g
         FROM src LEFT JOIN aim ON src.k = aim.k, tot),
sums AS (SELECT doc_id, sum(n) AS n_features, floor(sum(n * g) / sum(n)) AS weight FROM f JOIN crc USING (s) JOIN gain ON gain.k = c % 10000 GROUP BY doc_id),
sc AS (SELECT d.doc_id, len(w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
              CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
       FROM d LEFT JOIN sums USING (doc_id)),
rk AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM sc WHERE n_words >= 20)
SELECT sc.doc_id, n_features, weight, score, CASE WHEN r <= 25 * n // 100 THEN r END AS rank FROM sc LEFT JOIN rk USING (doc_id)""",
    "op12_trie": rf"""
WITH RECURSIVE t AS (SELECT conv_id AS c, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS x, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n,
                            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS p FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT c, CAST(c AS VARCHAR) AS s FROM t),{_crc("ids")},
heads AS (SELECT ids.c, crc.c % 9 AS h FROM ids JOIN crc USING (s)),
built AS (SELECT heads.c, 0 AS part, p, x, n FROM heads JOIN t ON t.c = heads.c - heads.c % 5 AND p < h
          UNION ALL SELECT t.c, 1, p, x, n FROM t JOIN heads USING (c) WHERE p >= h),
path AS (SELECT heads.c, coalesce(list(x ORDER BY part, p) FILTER (WHERE x IS NOT NULL), []) AS xs, coalesce(list(n ORDER BY part, p) FILTER (WHERE x IS NOT NULL), []) AS ns
         FROM heads LEFT JOIN built USING (c) GROUP BY heads.c),
occ AS (SELECT c, d, len(xs) AS long, array_to_string(list_slice(xs, 1, d), ',') AS node, CASE WHEN d > 0 THEN array_to_string(list_slice(xs, 1, d - 1), ',') END AS up, CASE WHEN d > 0 THEN ns[d] ELSE 0 END AS n
        FROM (SELECT *, unnest(range(0, len(xs) + 1)) AS d FROM path)),
nodes AS (SELECT node, up, d, min(c) AS conv_id, count(*) AS n_convs, max(n) AS n, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE long = d), '')) AS ends FROM occ GROUP BY node, up, d),
kids AS (SELECT up AS node, count(*) AS k FROM nodes WHERE up IS NOT NULL GROUP BY up),
above AS (SELECT DISTINCT o.node AS under, a.node AS node FROM occ o JOIN occ a ON a.c = o.c AND a.d <= o.d),
sub AS (SELECT above.node, sum((n_convs - 1) * nodes.n) AS saved, count(*) FILTER (WHERE kids.k IS NULL) AS leaves
        FROM above JOIN nodes ON nodes.node = under LEFT JOIN kids ON kids.node = under GROUP BY above.node)
SELECT v.conv_id, CAST(v.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, v.n_convs, CAST(coalesce(kids.k, 0) AS BIGINT) AS n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, v.ends AS ends_sha256
FROM nodes v JOIN sub USING (node) LEFT JOIN kids USING (node) LEFT JOIN nodes u ON u.node = v.up""",
    "op1_fixed_blocks": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
gone AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
cov AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM gone) GROUP BY doc_id),
wd AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM wd
         WHERE NOT EXISTS (SELECT 1 FROM (SELECT doc_id, unnest(ps) AS p FROM cov) c WHERE c.doc_id = wd.doc_id AND c.p = wd.p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op2_warc": """
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
k AS (SELECT digest, n, max(page_id) AS keeper FROM p WHERE n >= 1000 GROUP BY digest, n)
SELECT page_id, n AS payload_bytes, p.digest AS payload_digest, CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keeper <> page_id THEN keeper END AS refers_to, 'ok' AS status
FROM p LEFT JOIN k USING (digest, n)""",
    "op3_mixing": mixing_sql("documents", **MIX),
    "op8_decontaminate": rf"""
WITH d AS (SELECT doc_id, {_WORDS8} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS8} AS w FROM benchmark),
g AS (SELECT DISTINCT item, least(len(w), 13) AS m, array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS gram
      FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
m AS (SELECT DISTINCT m FROM g),
win AS (SELECT doc_id, m, i, array_to_string(list_slice(w, i, i + m - 1), ' ') AS gram
        FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, m WHERE len(w) >= m)),
hit AS (SELECT win.doc_id, win.m, win.i, g.item FROM win JOIN g ON win.m = g.m AND win.gram = g.gram),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN word USING (doc_id) LEFT JOIN its USING (doc_id)""",
}
