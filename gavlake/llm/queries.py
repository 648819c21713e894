"""Registered queries of this subpackage: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gavlake.llm.decontaminate import contaminated
from gavlake.llm.fingerprint import fingerprints
from gavlake.llm.jaccard_join import jaccard_components
from gavlake.llm.language import fit_languages, held_out, identify
from gavlake.llm.line_templates import line_report
from gavlake.llm.mixing import mix_report
from gavlake.llm.pii import pii_report
from gavlake.llm.quality import quality
from gavlake.llm.secret_scan import secret_report
from gavlake.llm.sharding import assign_shards
from gavlake.llm.source_divergence import source_divergence
from gavlake.llm.spelling import spelling_variants
from gavlake.llm.toxicity import toxicity

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_report(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (jaccard_components(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_shingles", "component_id"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_languages(docs.where("doc_id is not null").where(~held_out(2, 4)))
    return (identify(docs.select("doc_id", "text", held_out(2, 4).alias("held_out")), model)
            .select("doc_id", "held_out", "lang_pred", "score"))


def op8_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


REGISTRY: dict[str, Query] = {
    "op1_fingerprint": op1_fingerprint,
    "op2_pii": op2_pii,
    "op3_sharding": op3_sharding,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_toxicity": op5_toxicity,
    "op6_mixing": op6_mixing,
    "op7_language": op7_language,
    "op8_line_templates": op8_line_templates,
    "op9_decontamination": op9_decontamination,
    "op10_quality": op10_quality,
    "op11_secret_scan": op11_secret_scan,
    "op12_source_divergence": op12_source_divergence,
    "op13_spelling": op13_spelling,
}

ORACLE: dict[str, str] = {
    # sets of 5-word shingles, overlaps of all pairs with a common one, then reachability
    "op4_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(ws) = 0 THEN []::VARCHAR[]
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
      FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (SELECT doc_id AS v, doc_id AS u FROM documents
      UNION SELECT r.v, l.b FROM r JOIN l ON l.a = r.u)
SELECT d.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(r.u)::BIGINT AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN r ON r.v = d.doc_id
GROUP BY d.doc_id
""",
    # dense: every group has every kept term, every pair of sources is summed over all of them
    "op12_source_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws
  FROM documents),
t AS (SELECT id, lang, source, unnest(ws) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY lang, source, term),
x AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS ln
      FROM g JOIN kept k ON k.lang = g.lang
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (SELECT x.lang, x.source, x.term, x.n,
        1 + (1000000000::HUGEINT * (x.n + 1)) // (sum(x.n) OVER (PARTITION BY x.lang, x.source) + v.v) AS p,
        1 + (1000000000::HUGEINT * (x.ln + 1)) // (v.n + v.v) AS q
      FROM x JOIN v ON v.lang = x.lang),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE n > 0 AND p > q),
k AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank
      FROM r)
SELECT lang, source, part, item, value, rank FROM k WHERE part = 'pair' OR rank <= 200
""",
}
