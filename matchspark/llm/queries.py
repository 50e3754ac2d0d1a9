"""The corpus operators as queries: each reads its whole table and returns what its contract names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import credentials, decontaminate, fingerprint, html_text, langid, licenses, lm, mixing, neardup, pii


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_neighbours(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.personal_data(table(spark, sf_dir, "documents")))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    learned = langid.learn(docs.where(~langid.held_out(F.col("doc_id"))))
    return langid.predict(docs.select("doc_id", "text"), learned).select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "lang_rejected")


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


def op6_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op8_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(table(spark, sf_dir, "documents"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.digest(credentials.secrets(table(spark, sf_dir, "documents")))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_fingerprints, op2_decontaminate, op3_pii, op4_langid, op5_licenses, op6_neardup, op7_mixing, op8_lm, op9_secrets, op10_html)}


NEARDUP_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
                                    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words),
rows_ AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM rows_ a JOIN rows_ b ON a.x = b.x AND a.doc_id <> b.doc_id AND 100 * b.n >= 80 * a.n AND 100 * a.n >= 80 * b.n
  GROUP BY 1, 2),
links AS (SELECT a, b FROM common WHERE 100 * i >= 80 * (na + nb - i)),
reach AS (SELECT a AS doc_id, b AS other FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a),
least_ AS (SELECT doc_id, min(other) AS low FROM reach GROUP BY 1)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(l.low, s.doc_id)) AS component_id,
       s.doc_id = least(s.doc_id, coalesce(l.low, s.doc_id)) AS kept
FROM sets s LEFT JOIN least_ l ON s.doc_id = l.doc_id
"""

MIXING_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS same, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
by_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sizes GROUP BY source),
caps AS (SELECT *, source_size * 2.0::DOUBLE AS cap, CAST(sum(source_size) OVER () AS BIGINT) * 1.5::DOUBLE AS whole FROM by_source),
levels AS (
  SELECT *, whole - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_,
         sum(weight) OVER (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_
  FROM caps),
capped AS (SELECT *, cap * open_ <= weight * left_ AS full_ FROM levels),
rest AS (SELECT max_by(left_, open_) AS left_, max(open_) AS open_ FROM capped WHERE NOT full_),
targets AS (SELECT c.source, c.source_size, CASE WHEN c.full_ THEN c.cap ELSE r.left_ * c.weight / r.open_ END AS target FROM capped c CROSS JOIN rest r),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, coalesce(t.target / nullif(t.source_size, 0), 0) AS rate,
         ('0x' || substr(md5('mix' || coalesce(s.source, '')), 1, 4))::BIGINT / 65536.0::DOUBLE AS start_,
         row_number() OVER (PARTITION BY s.source ORDER BY length(bin(s.size)), substr(bin(s.size), 1, 5), substr(md5(concat_ws(':', coalesce(s.doc_id::VARCHAR, ''), s.same)), 1, 3), s.size, s.doc_id::VARCHAR, s.same) AS k
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
taken AS (SELECT *, CAST(least(floor(start_ + rate * k) - floor(start_ + rate * (k - 1)), ceil(rate)) AS BIGINT) AS copies FROM placed)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM taken
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_neardup": NEARDUP_SQL, "op7_mixing": MIXING_SQL}
