"""The catalog operators as queries over the driver's tables, each with the SQL that DuckDB holds it against."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import flags, fuzzy, size, text
from ..operators import analysis, catalog, knowledge, matching, similarity
from ..sources import tables

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def norm(x: str) -> str:
    return f"trim(regexp_replace(replace(lower(coalesce({x}, '')), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"


def toks(x: str) -> str:
    return f"list_distinct(list_filter(string_split({x}, ' '), lambda x: x <> ''))"


def jac(x: str, y: str) -> str:
    return f"round_even(coalesce(len(list_intersect({x}, {y})) / nullif(len(list_distinct(list_concat({x}, {y})))::DOUBLE, 0), 0), 6)"


#: The part table as products, for SQL. The forms of size texts are told apart by key, not parsed.
PARTS = f"""
raw_parts AS (
  SELECT *, (p_partkey // 2) % 4 AS turn, {norm("p_name")} AS name_norm, {norm("p_brand")} AS brand_norm, {norm("p_type")} AS category_norm FROM part),
parts AS (
  SELECT p_partkey::VARCHAR AS item_id, CASE WHEN p_partkey % 2 = 0 THEN 'A' ELSE 'B' END AS store_id, p_name AS name, p_brand AS brand_raw, p_type AS info_category_0,
    CASE turn WHEN 0 THEN p_size || ' oz' WHEN 1 THEN p_size || ' ct' WHEN 2 THEN '4 x ' || p_size || ' fl oz' ELSE p_size || '.5 lb' END AS size_text, p_retailprice AS price,
    name_norm, brand_norm, category_norm, CASE brand_norm WHEN 'brand 1' THEN 'brand 2' WHEN 'brand 4' THEN 'brand 5' ELSE brand_norm END AS brand,
    brand_norm IN ('brand 3', 'brand 7', 'brand 11') AS is_private_label,
    CASE turn WHEN 1 THEN 'count' WHEN 2 THEN 'volume' ELSE 'weight' END AS dim,
    CASE turn WHEN 3 THEN p_size * 16 + 8 ELSE p_size END::DOUBLE AS unit_value, CASE turn WHEN 3 THEN p_size * 16 + 8 WHEN 2 THEN p_size * 4 ELSE p_size END::DOUBLE AS total_value,
    CASE turn WHEN 1 THEN p_size WHEN 2 THEN 4 ELSE 1 END AS pack_count FROM raw_parts),
sized AS (
  SELECT *, CASE WHEN dim = 'count' AND unit_value <= 1 THEN '' ELSE dim || ':' || unit_value::BIGINT END AS unit_bucket,
    CASE WHEN dim = 'count' AND total_value <= 1 THEN '' ELSE dim || ':' || total_value::BIGINT END AS total_bucket FROM parts),
keys AS (SELECT DISTINCT item_id, store_id, brand, category_norm, is_private_label, unnest([unit_bucket, total_bucket]) AS bucket FROM sized),
blocked AS (
  SELECT DISTINCT a.item_id AS item_id_a, b.item_id AS item_id_b FROM keys a JOIN keys b ON a.brand = b.brand AND a.bucket = b.bucket
  WHERE a.store_id = 'A' AND b.store_id = 'B' AND a.bucket <> '' AND a.brand <> '')
"""

SIDE = ("name", "name_norm", "brand_raw", "brand_norm", "brand", "category_norm", "is_private_label", "dim", "unit_value", "total_value", "pack_count", "unit_bucket", "total_bucket", "size_text")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: What features() reads of a record.
ALIKE = ("name_norm", "brand_norm", "brand", "category_norm", "is_private_label", "dim", "unit_value", "total_value", "pack_count", "unit_bucket", "total_bucket")


#: What routed() reads of a record, and what score_bounds() does.
ROUTED = ("name_norm", "brand_norm", "brand", "is_private_label", "food_like", "dim", "unit_value", "unit_bucket", "total_bucket")
CORE = (*ROUTED, "total_value")


def unscored(pairs: DataFrame) -> DataFrame:
    return pairs.withColumns({"source": F.lit("T1"), "cosine": F.lit(None).cast("double"), "score": F.lit(None).cast("double")})


def products(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Pairs of block classes with both sides' attributes and features: one row stands for `pairs` pairs of records."""
    return matching.features(unscored(matching.block_products(*catalog.kinds(spark, sf_dir, *ALIKE, *more, ids=True))))


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """products() without what only scores depend on: categories and totals make no classes."""
    return matching.routed(unscored(matching.block_products(*catalog.kinds(spark, sf_dir, *ROUTED))))


def _words(c):
    return text.tokens(text.normalize(c))


#: What of_names() reads of a name, and a score of a category.
NAMES = ("name", {"words": _words, "flavors": lambda c: flags.hinted(_words(c), flags.FLAVOR), "forms": lambda c: flags.hinted(_words(c), flags.FORM)})
CATEGORIES = ("info_category_0", {"kinds": _words, "food_like": lambda c: flags.food_like(_words(c))})


# ---- scalar functions ----


@query(f"SELECT doc_id, {norm('text')} AS norm, CASE WHEN lower(trim(coalesce(text, ''))) IN ('', 'nan', 'none', 'null') THEN TRUE ELSE FALSE END AS missing FROM documents")
def normalize_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.normalize(F.col("text")).alias("norm"), text.is_missing(F.col("text")).alias("missing"))


@query(f"WITH {PARTS} SELECT item_id, brand_norm, brand, is_private_label FROM parts")
def canonical_brand(spark, sf_dir):
    return catalog.parts(spark, sf_dir).select("item_id", "brand_norm", "brand", "is_private_label")


@query(f"""SELECT page_id, {norm("regexp_extract(rtrim(url, '/'), '(?i)/([a-z0-9][a-z0-9_-]+)$', 1)")} AS slug,
  lower(array_to_string(list_transform(list_filter(string_split(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '' AND lower(x) NOT IN ('ip', 'shop', 'product') AND NOT regexp_full_match(x, '[0-9]+')),
    lambda x: regexp_replace(x, '^[0-9]+[-_]', '')), '-')) AS segments FROM pages""")
def url_slug(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.url_slug(F.col("url")).alias("slug"), text.url_segments_slug(F.col("url")).alias("segments"))


@query(f"""WITH t AS (SELECT d.doc_id, {toks(norm("d.text"))} AS a, {toks(norm("d.source || ' ' || d.lang"))} AS b, d.text FROM documents d)
  SELECT doc_id, {jac("a", "b")} AS jaccard, len(a) AS n_tokens FROM t""")
def token_jaccard(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    a, b = text.tokens(text.normalize(F.col("text"))), text.tokens(text.normalize(F.concat_ws(" ", "source", "lang")))
    return d.select("doc_id", F.bround(text.jaccard(a, b), 6).alias("jaccard"), F.size(text.tokens(text.normalize(F.col("text")))).cast("long").alias("n_tokens"))


#: The operator's terms stand in a name made of the part's, for the table has none of them.
TERMED = "name_norm || CASE p_partkey % 5 WHEN 0 THEN ' great value' WHEN 1 THEN ' wegmans organic' WHEN 2 THEN ' equate' ELSE '' END"


@query(f"""WITH t AS (SELECT p_partkey::VARCHAR AS item_id, {TERMED} AS n FROM (SELECT *, {norm("p_name")} AS name_norm FROM part))
  SELECT item_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(n, 'great value', ' '), 'marketside', ' '), 'bettergoods', ' '), 'equate', ' '), 'sam s choice', ' '), 'walmart', ' '), 'wegmans', ' '), ' +', ' ', 'g')) AS stripped FROM t""")
def strip_terms(spark, sf_dir):
    """Later terms that hold an earlier one find nothing: what stands of them is what the earlier one leaves."""
    key = F.col("item_id").cast("long") % 5
    named = F.concat("name_norm", F.when(key == 0, " great value").when(key == 1, " wegmans organic").when(key == 2, " equate").otherwise(""))
    return catalog.parts(spark, sf_dir).select("item_id", text.without_terms(named, text.PRIVATE_TERMS).alias("stripped"))


CODES_SQL = r"list_distinct(list_transform(regexp_extract_all({c}, '\b([0-9]{{4,16}})\b', 1), lambda x: CASE WHEN ltrim(x, '0') = '' THEN '0' ELSE ltrim(x, '0') END))"


@query(f"SELECT doc_id, array_to_string(list_sort({CODES_SQL.format(c='text')}), ',') AS codes, regexp_matches(text, '[0-9]{{12,14}}') AS has_code FROM documents")
def digit_codes(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.array_sort(text.codes(F.col("text"), 4, 16)), ",").alias("codes"), F.col("text").rlike("[0-9]{12,14}").alias("has_code"))


@query("SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[ \t]+', ' ', 'g'), '\n{3,}', '\n\n', 'g'), ' ') AS cleaned FROM documents")
def clean_lines(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_lines(F.col("text")).alias("cleaned"))


@query(f"""WITH {PARTS} SELECT item_id, list_has_any(string_split(category_norm, ' '), ['small', 'promo']) AS hinted, contains(name_norm, 'ring') AS organic_like,
  'name: ' || name || ' | brand: ' || brand_norm || ' | size: ' || size_text || ' | private label: ' || CASE WHEN is_private_label THEN 'yes' ELSE 'no' END AS embedding_text,
  sha256('model|64|v2|' || name_norm) AS hash FROM parts""")
def embedding_text(spark, sf_dir):
    p = catalog.parts(spark, sf_dir)
    flag = F.when(F.col("is_private_label"), "yes").otherwise("no")
    labelled = F.concat_ws(" | ", *[F.concat(F.lit(k), c) for k, c in (("name: ", F.col("name")), ("brand: ", F.col("brand_norm")), ("size: ", F.col("size_text")), ("private label: ", flag))])
    return p.select("item_id", flags.has_any(F.split("category_norm", " "), ("small", "promo")).alias("hinted"), F.contains("name_norm", F.lit("ring")).alias("organic_like"), labelled.alias("embedding_text"), knowledge.text_hash(F.col("name_norm"), "model", 64, "v2").alias("hash"))


@query(f"""WITH {PARTS} SELECT item_id, 'name: ' || name || chr(10) || 'brand: ' || brand_raw || chr(10) || 'size: ' || size_text || chr(10) || 'category: ' || info_category_0 AS prompt,
  substr(sha256(name_norm || '|' || brand_norm), 1, 16) AS signature, trim(name_norm || ' ' || brand_norm || ' ' || category_norm) AS retrieval_text FROM parts""")
def prompt_blocks(spark, sf_dir):
    p = catalog.parts(spark, sf_dir)
    c = F.col
    return p.select("item_id", knowledge.prompt(c("name"), c("brand_raw"), c("size_text"), c("info_category_0")).alias("prompt"), knowledge.signature(F.concat_ws("|", "name_norm", "brand_norm")).alias("signature"), F.trim(F.concat_ws(" ", "name_norm", "brand_norm", "category_norm")).alias("retrieval_text"))


# ---- sizes ----


@query(f"WITH {PARTS} SELECT item_id, size_text, dim, unit_value, total_value, pack_count, unit_bucket, total_bucket FROM sized")
def parse_size(spark, sf_dir):
    return catalog.parts(spark, sf_dir).select("item_id", "size_text", "dim", "unit_value", "total_value", "pack_count", "unit_bucket", "total_bucket")


RELATION = """CASE WHEN {a}.dim <> {b}.dim THEN 'conflict_dim' WHEN {a}.{v} / {b}.{v} BETWEEN 0.92 AND 1.08 THEN 'same' WHEN {a}.{v} / {b}.{v} BETWEEN 0.85 AND 1.15 THEN 'near'
  WHEN abs({a}.{v} / {b}.{v} - round_even({a}.{v} / {b}.{v}, 0)) < 0.1 AND round_even({a}.{v} / {b}.{v}, 0) BETWEEN 2 AND 24 THEN 'multipack'
  WHEN abs({b}.{v} / {a}.{v} - round_even({b}.{v} / {a}.{v}, 0)) < 0.1 AND round_even({b}.{v} / {a}.{v}, 0) BETWEEN 2 AND 24 THEN 'multipack' ELSE 'off' END"""
UNIT, TOTAL = RELATION.format(a="a", b="b", v="unit_value"), RELATION.format(a="a", b="b", v="total_value")
PACKS = "CASE WHEN a.pack_count = b.pack_count THEN 'same' WHEN a.pack_count = 1 OR b.pack_count = 1 THEN 'multipack' ELSE 'off' END"


@query(f"WITH {PARTS} SELECT x.item_id_a, x.item_id_b, {UNIT} AS unit_relation, {TOTAL} AS total_relation, {PACKS} AS pack_relation FROM blocked x JOIN sized a ON a.item_id = x.item_id_a JOIN sized b ON b.item_id = x.item_id_b")
def size_relation(spark, sf_dir):
    return matching.opened(matching.tile_pairs(*catalog.tiled(spark, sf_dir))).select("item_id_a", "item_id_b", "unit_relation", "total_relation", "pack_relation")


# ---- semi-structured columns and hygiene ----


@query("SELECT event_id, props->>'$.k' AS prop_k, props->>'$.z' AS prop_z FROM events")
def json_expand(spark, sf_dir):
    return catalog.nested(table(spark, sf_dir, "events"), "props", ["k", "z"], "prop").select("event_id", "prop_k", "prop_z")


@query("SELECT event_id, list_sort(CASE WHEN event_id % 2 = 0 THEN [event_type, user_id::VARCHAR] ELSE ['k'] END) AS tags FROM events")
def parse_tags(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    raw = F.when(F.col("event_id") % 2 == 0, F.to_json(F.array("event_type", F.col("user_id").cast("string")))).otherwise(F.to_json(F.create_map(F.lit("k"), F.lit("true"), F.lit("z"), F.lit("false"))))
    return e.select("event_id", F.array_sort(catalog.tag_list(raw)).alias("tags"))


@query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders WHERE o_custkey IS NOT NULL) SELECT o_custkey, o_orderkey, 'A' AS store_id FROM r WHERE n = 1")
def dedupe_keep_first(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("key", F.col("o_custkey").cast("string"))
    return catalog.hygiene(o, "key", "o_orderkey", "A").select("o_custkey", "o_orderkey", "store_id")


@query("SELECT doc_id, coalesce(nullif(trim(CASE WHEN doc_id % 3 = 0 THEN 'NaN' ELSE lang END), 'NaN'), source) AS first_value, concat_ws('|', lang, source) AS key FROM documents")
def first_non_missing(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    lang = F.when(F.col("doc_id") % 3 == 0, "NaN").otherwise(F.col("lang"))
    key = F.when(~text.is_missing(F.col("lang")) & ~text.is_missing(F.col("source")), F.concat_ws("|", "lang", "source")).otherwise("")
    return d.select("doc_id", text.first_present(lang, F.col("source")).alias("first_value"), key.alias("key"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def semi_filter(spark, sf_dir):
    return table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders").where("o_totalprice > 400000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_totalprice > 300000)")
def cache_misses(spark, sf_dir):
    bank = table(spark, sf_dir, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return tables.misses(table(spark, sf_dir, "customer").select("c_custkey"), bank, "c_custkey")


# ---- joins ----


@query(f"WITH {PARTS} SELECT * FROM blocked")
def strict_block_pairs(spark, sf_dir):
    return matching.opened(matching.tile_pairs(*catalog.tiled(spark, sf_dir)).select("items_a", "items_b"))


@query(f"WITH {PARTS} SELECT a.k AS brand, a.n AS count_a, b.n AS count_b, a.n * b.n AS pairs FROM (SELECT brand AS k, count(*) AS n FROM parts WHERE store_id = 'A' GROUP BY 1) a JOIN (SELECT brand AS k, count(*) AS n FROM parts WHERE store_id = 'B' GROUP BY 1) b ON a.k = b.k")
def block_stats(spark, sf_dir):
    p = catalog.parts(spark, sf_dir)
    return matching.block_stats(p.where("store_id = 'A'"), p.where("store_id = 'B'"), "brand")


@query(f"WITH {PARTS}, ka AS (SELECT DISTINCT brand, bucket FROM keys WHERE store_id = 'B' AND bucket <> '') SELECT count(DISTINCT k.item_id) AS covered, (SELECT count(*) FROM parts WHERE store_id = 'A') AS records FROM keys k JOIN ka ON k.brand = ka.brand AND k.bucket = ka.bucket WHERE k.store_id = 'A'")
def block_coverage(spark, sf_dir):
    a, b = catalog.sides(spark, sf_dir, "brand", "unit_bucket", "total_bucket")
    left = matching.block_keys(a, ["unit_bucket_a", "total_bucket_a"], ["item_id_a", F.col("brand_a").alias("brand")])
    right = matching.block_keys(b, ["unit_bucket_b", "total_bucket_b"], [F.col("brand_b").alias("brand")])
    return left.join(right, ["brand", "bucket"], "left_semi").agg(F.count_distinct("item_id_a").alias("covered")).crossJoin(a.agg(F.count("*").alias("records")))


@query("""WITH a AS (SELECT DISTINCT p_size AS v FROM part WHERE p_partkey % 2 = 0 AND p_retailprice < 1000), b AS (SELECT DISTINCT p_size AS v FROM part WHERE p_partkey % 3 = 1 AND p_retailprice >= 950)
  SELECT (SELECT count(*) FROM a) AS unique_a, (SELECT count(*) FROM b) AS unique_b, (SELECT count(*) FROM (SELECT v FROM a INTERSECT SELECT v FROM b)) AS shared, (SELECT count(*) FROM (SELECT v FROM a EXCEPT SELECT v FROM b)) AS only_a""")
def overlap_counts(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    a = p.where("p_partkey % 2 = 0 AND p_retailprice < 1000").select("p_size").distinct()
    b = p.where("p_partkey % 3 = 1 AND p_retailprice >= 950").select("p_size").distinct()
    both = a.withColumn("a", F.lit(1)).join(b.withColumn("b", F.lit(1)), "p_size", "full")
    return both.agg(F.count("a").alias("unique_a"), F.count("b").alias("unique_b"), F.count_if(F.expr("a = 1 AND b = 1")).alias("shared"), F.count_if(F.expr("a = 1 AND b IS NULL")).alias("only_a"))


BRIDGE = """seeds AS (SELECT DISTINCT x.item_id_a, x.item_id_b, a.category_norm AS a_category, b.category_norm AS b_category FROM blocked x JOIN parts a ON a.item_id = x.item_id_a JOIN parts b ON b.item_id = x.item_id_b),
  counts AS (SELECT a_category, b_category, count(*) AS pairs FROM seeds GROUP BY 1, 2), shares AS (SELECT *, sum(pairs) OVER (PARTITION BY a_category)::BIGINT AS support FROM counts),
  bridge AS (SELECT *, round_even(pairs / support::DOUBLE, 4) AS share, row_number() OVER (PARTITION BY a_category ORDER BY pairs DESC, b_category) AS rank FROM shares QUALIFY rank <= 3)"""


def bridge(spark, sf_dir):
    pairs = matching.block_products(*catalog.kinds(spark, sf_dir, "brand", "category_norm", "unit_bucket", "total_bucket"))
    return matching.category_bridge(pairs.select(F.col("category_norm_a").alias("a_category"), F.col("category_norm_b").alias("b_category"), "pairs"), weight="pairs")


@query(f"WITH {PARTS}, {BRIDGE} SELECT a_category, b_category, pairs, support, share, rank FROM bridge")
def category_bridge(spark, sf_dir):
    return bridge(spark, sf_dir)


@query(f"WITH {PARTS}, {BRIDGE} SELECT count(*) AS records, count(*) FILTER (category_norm IN (SELECT a_category FROM bridge)) AS bridged, count(*) FILTER (category_norm IN (SELECT a_category FROM bridge WHERE rank = 1 AND share >= 0.2)) AS sure FROM parts WHERE store_id = 'A'")
def bridge_coverage(spark, sf_dir):
    a = catalog.parts(spark, sf_dir).where("store_id = 'A'")
    best = bridge(spark, sf_dir).where("rank = 1").select(F.col("a_category").alias("category_norm"), "share")
    return a.join(best, "category_norm", "left").agg(F.count("*").alias("records"), F.count("share").alias("bridged"), F.count_if(F.col("share") >= 0.2).alias("sure"))


@query(f"""WITH {PARTS}, {BRIDGE} SELECT DISTINCT a.item_id AS item_id_a, b.item_id AS item_id_b FROM keys a JOIN bridge m ON m.a_category = a.category_norm JOIN keys b ON b.category_norm = m.b_category AND b.bucket = a.bucket
  WHERE a.store_id = 'A' AND b.store_id = 'B' AND a.is_private_label AND b.is_private_label AND a.bucket <> ''""")
def private_label_pairs(spark, sf_dir):
    a, b = catalog.sides(spark, sf_dir, "category_norm", "is_private_label", "unit_bucket", "total_bucket")
    return matching.private_label_pairs(a, b, bridge(spark, sf_dir))


@query("""WITH o AS (SELECT o_orderkey, 'order 00' || lpad(((o_orderkey * 7919) % 1000 + 100000000000)::VARCHAR, 12, '0') || ' of ' || o_orderstatus AS t FROM orders),
  c AS (SELECT c_custkey, 'customer ' || lpad((c_custkey + 100000000000)::VARCHAR, 13, '0') AS t FROM customer),
  oc AS (SELECT o_orderkey, unnest(list_distinct(list_transform(regexp_extract_all(t, '\\b([0-9]{12,14})\\b', 1), lambda x: ltrim(x, '0')))) AS code FROM o),
  cc AS (SELECT c_custkey, unnest(list_distinct(list_transform(regexp_extract_all(t, '\\b([0-9]{12,14})\\b', 1), lambda x: ltrim(x, '0')))) AS code FROM c)
  SELECT DISTINCT o_orderkey, c_custkey, code FROM oc JOIN cc USING (code)""")
def code_join(spark, sf_dir):
    """Product codes of 12 to 14 digits, written with leading zeros on both sides: the tables hold none, so texts of keys stand for them."""
    code = lambda n, width: F.lpad((n + 100_000_000_000).cast("string"), width, "0")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("order 00"), code((F.col("o_orderkey") * 7919) % 1000, 12), F.lit(" of "), "o_orderstatus").alias("t"))
    c = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("customer "), code(F.col("c_custkey"), 13)).alias("t"))
    left, right = (d.select(k, F.explode(text.codes(F.col("t"))).alias("code")) for d, k in ((o, "o_orderkey"), (c, "c_custkey")))
    return left.join(right, "code").select("o_orderkey", "c_custkey", "code").distinct()


@query(f"""WITH {PARTS}, scored AS (SELECT x.item_id_a, x.item_id_b, {jac(toks("a.name_norm"), toks("b.name_norm"))} AS jaccard FROM blocked x JOIN parts a ON a.item_id = x.item_id_a JOIN parts b ON b.item_id = x.item_id_b)
  SELECT item_id_a, item_id_b, jaccard FROM scored QUALIFY row_number() OVER (PARTITION BY item_id_a ORDER BY jaccard DESC, item_id_b) = 1""")
def best_name_in_block(spark, sf_dir):
    by = ["name_norm", *matching.BLOCKED]
    a, b = catalog.sides(spark, sf_dir, *by)
    alike = F.bround(text.jaccard(text.tokens(F.col("name_norm_a")), text.tokens(F.col("name_norm_b"))), 6)
    best = matching.block_firsts(a, b, 1, by, lambda p: p.withColumn("jaccard", alike), [F.desc("jaccard")])
    return matching.classed(a, "a", by).join(best, "class_a").select("item_id_a", "item_id_b", "jaccard")


@query(f"""WITH {PARTS}, pairs AS (SELECT a.item_id AS item_id_a, b.item_id AS item_id_b, a.unit_bucket = b.unit_bucket AS same FROM sized a JOIN sized b ON a.brand = b.brand AND a.category_norm = b.category_norm WHERE a.store_id = 'A' AND b.store_id = 'B'),
  marked AS (SELECT *, bool_or(same) OVER (PARTITION BY item_id_a) AS any_same FROM pairs)
  SELECT item_id_a, any_same AS narrowed, count(*) AS pool, min(item_id_b) AS first_b FROM marked WHERE same OR NOT any_same GROUP BY 1, 2""")
def narrowed_block(spark, sf_dir):
    """Only counts and first ids meet: a record's pool is the size of its bucket of brand and category, or of the whole where the bucket has none."""
    a, b = catalog.sides(spark, sf_dir, "brand", "category_norm", "unit_bucket")
    a, b = (d.toDF("item_id", "brand", "category", "bucket") for d in (a, b))
    buckets = b.groupBy("brand", "category", "bucket").agg(F.count("*").alias("n"), F.min("item_id").alias("first"))
    whole = buckets.groupBy("brand", "category").agg(F.sum("n").alias("all_n"), F.min("first").alias("all_first"))
    narrow = a.withColumnRenamed("item_id", "item_id_a").join(whole, ["brand", "category"]).join(buckets, ["brand", "category", "bucket"], "left")
    return narrow.select("item_id_a", F.col("n").isNotNull().alias("narrowed"), F.coalesce("n", "all_n").alias("pool"), F.coalesce("first", "all_first").alias("first_b"))


@query()
def alias_fuzzy_join(spark, sf_dir):
    """Brands of B that A lacks, each with A's most similar brand; no rows where A has them all."""
    p = catalog.parts(spark, sf_dir).withColumn("b", F.concat_ws(" ", "brand_norm", "category_norm")).where("b != ''")
    a, b = (p.where(F.col("store_id") == s).select("b").distinct() for s in "AB")
    return matching.similar_names(b.join(a, "b", "left_anti").select(F.col("b").alias("b_brand")), a.select(F.col("b").alias("a_brand")))


# ---- similarity ----


@query("""WITH w AS (SELECT item_id AS id, list_filter(regexp_extract_all(lower(text), '[a-z0-9_]+'), lambda x: len(x) > 1) AS w FROM (SELECT item_id, regexp_replace(text, '[^ -~]', ' ', 'g') AS text FROM benchmark)),
  grams AS (SELECT id, unnest(list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM w),
  tf AS (SELECT id, 'w:' || term AS term, count(*) AS tf FROM grams GROUP BY 1, 2), n AS (SELECT count(*) AS n FROM benchmark),
  df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1), x AS (SELECT id, term, (1 + ln(tf)) * (ln((1 + n) / (1 + df)::DOUBLE) + 1) AS w FROM tf JOIN df USING (term), n WHERE df >= 2 AND df <= 0.6 * n),
  norms AS (SELECT id, sqrt(sum(w * w)) AS norm FROM x GROUP BY 1) SELECT id, term, round(w / norm, 5) AS weight FROM x JOIN norms USING (id)""")
def tfidf_weights(spark, sf_dir):
    plain = F.regexp_replace("text", "[^ -~]", " ")
    return similarity.tfidf(table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), plain.alias("text")), chars=False).select("id", "term", F.round("weight", 5).alias("weight"))


GRAMS = """padded AS (SELECT id, text, unnest(list_transform(list_filter(string_split(text, ' '), lambda x: x <> ''), lambda x: ' ' || x || ' ')) AS p FROM corpus),
  chars AS (SELECT id, 'c:' || unnest(list_concat(list_concat(CASE WHEN len(p) > 3 THEN list_transform(range(1, len(p) - 1), lambda i: p[i:i + 2]) ELSE [p] END, CASE WHEN len(p) > 4 THEN list_transform(range(1, len(p) - 2), lambda i: p[i:i + 3]) WHEN len(p) = 4 THEN [p] ELSE [] END),
    CASE WHEN len(p) > 5 THEN list_transform(range(1, len(p) - 3), lambda i: p[i:i + 4]) WHEN len(p) = 5 THEN [p] ELSE [] END)) AS term FROM padded),
  ws AS (SELECT id, list_filter(string_split(text, ' '), lambda x: len(x) > 1) AS w FROM corpus),
  grams AS (SELECT id, 'w:' || unnest(list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM ws UNION ALL SELECT * FROM chars),
  tf AS (SELECT id, term, count(*) AS tf FROM grams GROUP BY 1, 2), n AS (SELECT count(*) AS n FROM corpus), df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
  x AS (SELECT id, term, (1 + ln(tf)) * (ln((1 + n) / (1 + df)::DOUBLE) + 1) AS w FROM tf JOIN df USING (term), n WHERE df >= 2 AND df <= 0.6 * n),
  norms AS (SELECT id, sqrt(sum(w * w)) AS norm FROM x GROUP BY 1), v AS (SELECT id, term, w / norm AS w FROM x JOIN norms USING (id))"""


@query(f"""WITH corpus AS (SELECT p_partkey::VARCHAR AS id, {norm("p_name || ' ' || p_type")} AS text, p_partkey % 2 AS side FROM part), {GRAMS},
  dots AS (SELECT a.id AS id_a, b.id AS id_b, round(sum(a.w * b.w), 6) AS score FROM v a JOIN v b USING (term) WHERE a.id::BIGINT % 2 = 0 AND b.id::BIGINT % 2 = 1 GROUP BY 1, 2)
  SELECT id_a, id_b, rank, round(score, 4) AS score FROM (SELECT *, row_number() OVER (PARTITION BY id_a ORDER BY score DESC, id_b) AS rank FROM dots WHERE score >= 0.4) WHERE rank <= 20""")
def tfidf_topk(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), text.normalize(F.concat_ws(" ", "p_name", "p_type")).alias("text"), (F.col("p_partkey") % 2).alias("side"))
    found = similarity.sparse_topk(p.where("side = 0").select("id", "text"), p.where("side = 1").select("id", "text"))
    return found.select("id_a", "id_b", "rank", F.round("score", 4).alias("score"))


@query("""WITH q AS (SELECT a.vec_id AS id_a, b.vec_id AS id_b, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score FROM embeddings a JOIN embeddings b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id)
  SELECT id_a, id_b, rank, round(score, 4) AS score FROM (SELECT *, row_number() OVER (PARTITION BY id_a ORDER BY score DESC, id_b) AS rank FROM q) WHERE rank <= 5""")
def dense_topk(spark, sf_dir):
    """Queries are the rows whose id is divisible by 20, against all other rows."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    found = similarity.dense_topk(e.where("id % 20 = 0"), e, 6).where("id_a != id_b").drop("rank")
    return matching.top(found, ["id_a"], [F.desc("score"), "id_b"], 5).select("id_a", "id_b", "rank", F.round("score", 4).alias("score"))


@query("""WITH q AS (SELECT a.vec_id AS id_a, b.vec_id AS id_b, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id % 20 = 0)
  SELECT id_a, id_b, rank, round(score, 4) AS score FROM (SELECT *, row_number() OVER (PARTITION BY id_a ORDER BY score DESC, id_b) AS rank FROM q WHERE score >= 0.2) WHERE rank <= 3""")
def typed_knn(spark, sf_dir):
    """Nearest entries of the query's own type, from a least score."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")
    return similarity.dense_topk(e.where("id % 20 = 0"), e, 3, 0.2, same="label").select("id_a", "id_b", "rank", F.round("score", 4).alias("score"))


@query("SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 5) AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def vector_cosine(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    b = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(b, "vec_id").select("vec_id", F.round(similarity.cosine(F.col("embedding"), F.col("other")), 5).alias("cosine"))


# ---- candidates, scores, selection ----

UNION = f"""{PARTS}, {BRIDGE}, private AS (SELECT DISTINCT a.item_id AS item_id_a, b.item_id AS item_id_b FROM keys a JOIN bridge m ON m.a_category = a.category_norm JOIN keys b ON b.category_norm = m.b_category AND b.bucket = a.bucket
  WHERE a.store_id = 'A' AND b.store_id = 'B' AND a.is_private_label AND b.is_private_label AND a.bucket <> ''),
  every AS (SELECT *, 'T1' AS source, 90.0 AS score FROM blocked UNION ALL SELECT *, 'T5', 60.0 FROM private)"""


UNITED = ("brand", "category_norm", "is_private_label", "unit_bucket", "total_bucket")


@query(f"WITH {UNION} SELECT item_id_a, item_id_b, string_agg(DISTINCT source, '+' ORDER BY source) AS source, max(score)::DOUBLE AS score FROM every GROUP BY 1, 2")
def candidate_union(spark, sf_dir):
    """Sources are gathered for pairs of classes, before the classes' records are paired."""
    a, b = catalog.sides(spark, sf_dir, *UNITED)
    left, right = (matching.classed(d, s).select(f"class_{s}").distinct() for d, s in ((a, "a"), (b, "b")))
    one = matching.block_join(left, right).withColumns({"source": F.lit("T1"), "score": F.lit(90.0)})
    two = matching.private_label_join(left, right, bridge(spark, sf_dir)).withColumns({"source": F.lit("T5"), "score": F.lit(60.0)})
    return matching.expand(matching.union_candidates(one, two, by=("class_a", "class_b")), a, b)


SCORED = f"""{PARTS}, rel AS (SELECT x.*, a.name_norm AS na, b.name_norm AS nb, CASE WHEN a.brand_norm = b.brand_norm THEN 'exact' WHEN a.brand = b.brand THEN 'alias' ELSE 'conflict' END AS brand_relation, {UNIT} AS unit_relation, {TOTAL} AS total_relation,
    {jac(toks("a.name_norm"), toks("b.name_norm"))} AS nj, {jac(toks("a.category_norm"), toks("b.category_norm"))} AS cj FROM blocked x JOIN sized a ON a.item_id = x.item_id_a JOIN sized b ON b.item_id = x.item_id_b),
  vetoed AS (SELECT *, concat_ws(',', CASE WHEN brand_relation = 'conflict' THEN 'brand_conflict' END, CASE WHEN unit_relation = 'conflict_dim' THEN 'size_dim_conflict' END) AS veto_reasons FROM rel),
  points AS (SELECT *, CASE brand_relation WHEN 'exact' THEN 0.35::DOUBLE WHEN 'alias' THEN 0.3 ELSE 0 END AS bp, CASE unit_relation WHEN 'same' THEN 0.3::DOUBLE WHEN 'multipack' THEN 0.22 WHEN 'near' THEN 0.18 ELSE 0 END AS up FROM vetoed),
  scored AS (SELECT *, CASE WHEN veto_reasons <> '' THEN 0 ELSE round_even(bp + (CASE WHEN total_relation = 'same' THEN greatest(up, 0.22) ELSE up END) + 0.18::DOUBLE * (100 * nj) / 100 + 0.12::DOUBLE * 0 + 0.05::DOUBLE * cj, 4) END AS final_score,
    CASE WHEN veto_reasons <> '' THEN 'drop' WHEN brand_relation IN ('exact', 'alias') AND unit_relation IN ('same', 'multipack') AND 100 * nj >= 92 THEN 'auto_accept' ELSE 'route_to_llm' END AS route FROM points)"""


@query(f"WITH {SCORED} SELECT item_id_a, item_id_b, brand_relation, unit_relation, total_relation, nj AS name_jaccard, cj AS category_jaccard, veto_reasons, round(final_score, 3) AS final_score, route FROM scored")
def score_route(spark, sf_dir):
    """Names compared by token Jaccard in place of the fuzzy ratio: once for two tiles' names, and categories once for two names' categories."""
    told = ["brand_relation", "unit_relation", "total_relation", "name_jaccard", "category_jaccard", "veto_reasons", "final_score", "route"]
    named = matching.of_names(matching.opened(matching.tile_pairs(*catalog.tiled(spark, sf_dir, NAMES, CATEGORIES))))
    named = named.drop(*[f"{c}_{s}" for c in ("words", "flavors", "forms") for s in "ab"])
    pairs = matching.decided(unscored(matching.opened(named))).withColumn("category_jaccard", F.bround(text.jaccard(F.col("kinds_a"), F.col("kinds_b")), 6))
    scored = pairs.withColumn("final_score", F.round(matching.scored_by(F.col("category_jaccard")), 3)).select("items_a", "items_b", *told)
    return matching.opened(scored).select("item_id_a", "item_id_b", *told)


def bounded(pairs: DataFrame) -> DataFrame:
    return matching.score_bounds(unscored(pairs))


@query(f"WITH {SCORED} SELECT item_id_a, item_id_b, round(final_score, 3) AS final_score FROM scored WHERE route <> 'drop' QUALIFY row_number() OVER (PARTITION BY item_id_a ORDER BY round(final_score, 3) DESC, item_id_b) = 1")
def select_one(spark, sf_dir):
    """Chosen for each class of records alike; of a class of partners the first id is the best."""
    a, b = catalog.sides(spark, sf_dir, *ALIKE, "food_like")
    near = matching.near_best(a, b, 1, [*ALIKE, "food_like"], list(CORE), lambda p: bounded(p).where("route != 'drop'"))
    scored = matching.features(unscored(near)).where("route != 'drop'").withColumns({"item_id_b": F.col("firsts")[0]["item_id_b"], "final_score": F.round("final_score", 3), "confidence": F.lit(None).cast("double")})
    best = matching.select_one(scored.select("class_a", "item_id_b", "final_score", "confidence", "score"), "class_a")
    return matching.classed(a, "a").join(best, "class_a").select("item_id_a", "item_id_b", "final_score")


@query(f"WITH {SCORED} SELECT route, count(*) AS pairs, count(*) FILTER (100 * nj >= 95) AS b95, count(*) FILTER (100 * nj >= 85 AND 100 * nj < 95) AS b85, count(*) FILTER (100 * nj >= 70 AND 100 * nj < 85) AS b70, count(*) FILTER (100 * nj < 70) AS low FROM scored GROUP BY 1")
def score_bands(spark, sf_dir):
    f, n = F.col("fuzzy"), analysis.weighted_count
    return routes(spark, sf_dir).groupBy("route").agg(n(F.lit(True), "pairs").alias("pairs"), n(f >= 95, "pairs").alias("b95"), n((f >= 85) & (f < 95), "pairs").alias("b85"), n((f >= 70) & (f < 85), "pairs").alias("b70"), n(f < 70, "pairs").alias("low"))


@query(f"WITH {SCORED}, c AS (SELECT count(*) FILTER (route = 'auto_accept') AS auto, count(*) FILTER (route = 'route_to_llm') AS llm FROM scored) SELECT auto, llm, floor(auto * 0.05::DOUBLE)::BIGINT AS projected_auto, floor(llm * 0.15::DOUBLE)::BIGINT AS projected_llm, floor(auto * 0.05::DOUBLE) + floor(llm * 0.15::DOUBLE) >= 4000 AS go FROM c")
def projection(spark, sf_dir):
    c = routes(spark, sf_dir).agg(*[analysis.weighted_count(F.col("route") == r, "pairs").alias(n) for r, n in (("auto_accept", "auto"), ("route_to_llm", "llm"))])
    c = c.withColumns({"projected_auto": F.floor(F.col("auto") * 0.05), "projected_llm": F.floor(F.col("llm") * 0.15)})
    return c.withColumn("go", F.col("projected_auto") + F.col("projected_llm") >= 4000)


@query("SELECT l_orderkey, l_linenumber, rank FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS rank FROM lineitem) WHERE rank <= 2")
def topk_per_group(spark, sf_dir):
    return matching.top(table(spark, sf_dir, "lineitem"), ["l_orderkey"], [F.desc("l_extendedprice"), "l_linenumber"], 2).select("l_orderkey", "l_linenumber", "rank")


def partners(spark, sf_dir, score, k=5) -> tuple[DataFrame, DataFrame]:
    """Records of A with their class, and the k best block partners (class_a, item_id_b, final_score) of each class; score: of the exact one."""
    by = [*ALIKE, "food_like"]
    a, b = catalog.sides(spark, sf_dir, *by)
    scored = lambda p: matching.features(unscored(p)).select("class_a", "class_b", "firsts", score(F.col("final_score")).alias("final_score"))
    best = matching.block_firsts(a, b, k, by, scored, [F.desc("final_score")], list(CORE), bounded).select("class_a", "item_id_b", "final_score")
    return matching.classed(a, "a"), best


@query(f"WITH {SCORED}, r AS (SELECT *, row_number() OVER (PARTITION BY item_id_a ORDER BY round(final_score, 3) DESC, item_id_b) AS rank FROM scored), g AS (SELECT item_id_a, list(item_id_b ORDER BY rank) AS b FROM r WHERE rank <= 5 GROUP BY 1) SELECT item_id_a, array_to_string(b, '|') AS b_ids, sha256('r1' || chr(31) || item_id_a || chr(31) || array_to_string(b, '|')) AS cache_key FROM g")
def judge_requests(spark, sf_dir):
    a, best = partners(spark, sf_dir, lambda c: F.round(c, 3))
    r = a.join(knowledge.requests(best, by="class_a"), "class_a")
    return r.select("item_id_a", F.array_join("b_ids", "|").alias("b_ids"), knowledge.cache_key("r1", F.col("item_id_a"), F.col("b_ids")).alias("cache_key"))


@query("""SELECT conv_id, turn, turn % 3 <> 2 AS json_valid, CASE WHEN turn % 3 = 0 THEN TRUE ELSE FALSE END AS is_match, CASE WHEN turn % 3 = 0 THEN 1 END AS best_candidate_index, CASE WHEN turn % 3 = 0 THEN 'exact' ELSE 'no_match' END AS match_type, CASE WHEN turn % 3 = 0 THEN 0.9 ELSE 0 END::DOUBLE AS confidence FROM conversations""")
def judge_parse(spark, sf_dir):
    raw = F.when(F.col("turn") % 3 == 0, '{"is_match": true, "best_candidate_index": 1, "match_type": "exact", "confidence": 0.9}').when(F.col("turn") % 3 == 1, '{"is_match": false}').otherwise("no json")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", knowledge.parse_judgment(raw).alias("j")).select("conv_id", "turn", "j.*")


@query()
def judge_offline(spark, sf_dir):
    a, best = partners(spark, sf_dir, lambda c: c)
    return knowledge.answers(a.join(knowledge.listed(best, by="class_a"), "class_a")).drop("raw_response")


def staged(df: DataFrame) -> DataFrame:
    """df written to spark.checkpoint.dir, or a temporary folder where it is unset in a single process, and read again."""
    folder, master = df.sparkSession.conf.get("spark.checkpoint.dir", None), df.sparkSession.conf.get("spark.master", "")
    if not folder and master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = folder or f"file://{tempfile.mkdtemp(prefix='matchspark-')}"
    return tables.stage(df, f"{folder.rstrip('/')}/matchspark-{uuid.uuid4().hex}")


def candidates(spark, sf_dir):
    """The best of blocks and of the category map by fuzzy ratio, and the TF-IDF join's pairs with their cosines."""
    a, b = catalog.sides(spark, sf_dir, *SIDE)
    a, b = (d.select(F.col(f"item_id_{s}").alias("id"), F.trim(F.concat_ws(" ", f"name_norm_{s}", f"brand_norm_{s}", f"category_norm_{s}")).alias("text")) for d, s in ((a, "a"), (b, "b")))
    found = similarity.sparse_topk(a, b).select(F.col("id_a").alias("item_id_a"), F.col("id_b").alias("item_id_b"), F.lit("T3").alias("source"), (100 * F.col("score")).alias("score"), F.col("score").alias("cosine"))
    a, b = catalog.sides(spark, sf_dir, *SIDE)
    one = matching.strict_block_top(a, b).withColumn("source", F.lit("T1"))
    two = matching.private_label_top(a, b, bridge(spark, sf_dir)).withColumn("source", F.lit("T5"))
    return matching.union_candidates(found, one, two)


@query()
def strict_block_top(spark, sf_dir):
    """The three best partners of a block by fuzzy ratio."""
    return matching.strict_block_top(*catalog.sides(spark, sf_dir, *SIDE))


@query()
def private_label_top(spark, sf_dir):
    """The five best private-label partners over the sure entries of the category map, from a fuzzy ratio of 60."""
    return matching.private_label_top(*catalog.sides(spark, sf_dir, *SIDE), bridge(spark, sf_dir))


@query()
def match_catalogs(spark, sf_dir):
    """All candidate sources, fuzzy scores, routes, the offline judge for what is in doubt, and one partner a record."""
    a, b = catalog.sides(spark, sf_dir, *SIDE)
    pairs = staged(candidates(spark, sf_dir)).join(a, "item_id_a").join(b, "item_id_b")  # else each use below plans all sources anew
    pairs = matching.with_ratio(pairs, "name_norm_a", "name_norm_b", "ratio")
    scored = staged(matching.features(pairs, F.col("ratio")).select("item_id_a", "item_id_b", "source", "score", "final_score", "route"))
    auto = scored.where("route = 'auto_accept'").withColumn("confidence", F.lit(None).cast("double"))
    judged = knowledge.judge(scored.where("route = 'route_to_llm'")).where("is_match AND confidence >= 0.85").select("item_id_a", "item_id_b", "confidence")
    return matching.select_one(auto.unionByName(scored.join(judged, ["item_id_a", "item_id_b"]))).select("item_id_a", "item_id_b", "source", "final_score", "confidence")


# ---- evaluation and profiling ----

EVAL = "e AS (SELECT l.quality = 1 AS truth, d.n_chars > 1500 AS guess, d.lang, least(d.n_chars / 4000.0::DOUBLE, 1.0) AS confidence FROM labels l JOIN documents d USING (doc_id))"
CELLS = "count(*) AS n, count(*) FILTER (truth AND guess) AS tp, count(*) FILTER (NOT truth AND guess) AS fp, count(*) FILTER (truth AND NOT guess) AS fn, count(*) FILTER (NOT truth AND NOT guess) AS tn"
RATES = "*, round_even(tp / nullif(tp + fp, 0)::DOUBLE, 4) AS precision, round_even(tp / nullif(tp + fn, 0)::DOUBLE, 4) AS recall"
F1 = "*, round_even(2 * precision * recall / nullif(precision + recall, 0), 4) AS f1"


def evaluated(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return table(spark, sf_dir, "labels").join(d, "doc_id").select((F.col("quality") == 1).alias("truth"), (F.col("n_chars") > 1500).alias("guess"), "lang", F.least(F.col("n_chars") / 4000.0, F.lit(1.0)).alias("confidence"))


@query(f"WITH {EVAL}, c AS (SELECT {CELLS} FROM e), r AS (SELECT {RATES} FROM c) SELECT {F1} FROM r")
def eval_confusion(spark, sf_dir):
    return analysis.confusion(evaluated(spark, sf_dir), "truth", "guess")


@query(f"WITH {EVAL}, c AS (SELECT lang, {CELLS} FROM e GROUP BY 1), r AS (SELECT {RATES} FROM c) SELECT {F1} FROM r")
def eval_by_stratum(spark, sf_dir):
    return analysis.confusion(evaluated(spark, sf_dir), "truth", "guess", ["lang"])


@query(f"""WITH {EVAL}, bands AS (SELECT * FROM (VALUES (0.0::DOUBLE, 0.5::DOUBLE), (0.5, 0.7), (0.7, 0.85), (0.85, 0.95), (0.95, 1.01)) t(low, high))
  SELECT low, high, count(e.truth) AS n, round_even(count(*) FILTER (e.truth) / nullif(count(e.truth), 0)::DOUBLE, 4) AS accuracy FROM bands LEFT JOIN e ON confidence >= low AND confidence < high AND guess GROUP BY 1, 2""")
def calibration_bins(spark, sf_dir):
    return analysis.calibration(evaluated(spark, sf_dir).where("guess"), "confidence", "truth")


@query(f"WITH {EVAL} SELECT truth, count(*) FILTER (NOT guess) AS no, count(*) FILTER (guess) AS yes FROM e GROUP BY 1")
def confusion_pivot(spark, sf_dir):
    return evaluated(spark, sf_dir).withColumn("g", F.when(F.col("guess"), "yes").otherwise("no")).groupBy("truth").pivot("g", ["no", "yes"]).count().na.fill(0)


@query(f"WITH {EVAL} SELECT count(*) FILTER (guess) AS always, count(*) FILTER (guess AND confidence >= 0.85) AS sure, count(*) FILTER (guess AND truth AND confidence >= 0.85) AS sure_right, round_even(avg((truth = guess)::INT), 4) AS accuracy FROM e")
def policy_simulation(spark, sf_dir):
    sure = F.expr("guess AND confidence >= 0.85")
    return evaluated(spark, sf_dir).agg(F.count_if("guess").alias("always"), F.count_if(sure).alias("sure"), F.count_if(sure & F.col("truth")).alias("sure_right"), F.bround(F.avg((F.col("truth") == F.col("guess")).cast("int")), 4).alias("accuracy"))


@query("SELECT lang, round(quantile_cont(n_chars, 0.5), 4) AS p50, round(quantile_cont(n_chars, 0.9), 4) AS p90, round(quantile_cont(n_chars, 0.99), 4) AS p99 FROM documents GROUP BY 1")
def text_length_quantiles(spark, sf_dir):
    return analysis.quantiles(table(spark, sf_dir, "documents"), "n_chars", ["lang"])


@query("WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE value IS NOT NULL) SELECT event_type, max(value) FILTER (i = greatest(floor(0.9::DOUBLE * n), 1)) AS p90, max(value) FILTER (i = greatest(floor(0.99::DOUBLE * n), 1)) AS p99 FROM r GROUP BY 1")
def latency_percentiles(spark, sf_dir):
    return analysis.index_quantiles(table(spark, sf_dir, "events"), "value", ["event_type"])


def _summary_sql(t: str, columns: list[str]) -> str:
    gone = "lower(trim(coalesce({c}::VARCHAR, ''))) IN ('', 'nan', 'none', 'null')"
    one = "SELECT 'X' AS store, '{c}' AS \"column\", count(*) FILTER (NOT ({g})) AS nonmissing, count(*) FILTER ({g}) AS missing, round_even(100 * count(*) FILTER ({g}) / count(*)::DOUBLE, 4) AS missing_pct, count(DISTINCT {c}) FILTER (NOT ({g})) AS distinct_nonmissing, min({c}::VARCHAR) FILTER (NOT ({g})) AS example FROM {t}"
    return " UNION ALL ".join(one.format(c=c, t=t, g=gone.format(c=c)) for c in columns)


@query(_summary_sql("customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]))
def column_summary(spark, sf_dir):
    return analysis.column_summary(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), "X")


@query("""WITH v AS (SELECT 'lang' AS field, lang AS value FROM documents UNION ALL SELECT 'source', source FROM documents), c AS (SELECT field, value, count(*) AS count FROM v WHERE value IS NOT NULL GROUP BY 1, 2)
  SELECT field, value, count, round_even(count / sum(count) OVER (PARTITION BY field)::DOUBLE, 6) AS share, row_number() OVER (PARTITION BY field ORDER BY count DESC, value) AS rank FROM c QUALIFY rank <= 25""")
def top_values(spark, sf_dir):
    return analysis.top_values(table(spark, sf_dir, "documents"), ["lang", "source"])


@query("SELECT count(*) AS n, count(DISTINCT text) AS distinct_texts, count(*) - count(DISTINCT text) AS duplicates, round_even(avg((text IS NOT NULL)::INT), 4) AS nonmissing_rate, count(*) FILTER (regexp_matches(text, '[0-9]')) AS with_digits, count(*) FILTER (regexp_matches(lower(text), 'license')) AS licensed FROM documents")
def duplicate_counts(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").agg(F.count("*").alias("n"), F.count_distinct("text").alias("distinct_texts"), (F.count("*") - F.count_distinct("text")).alias("duplicates"), F.bround(F.avg(t.isNotNull().cast("int")), 4).alias("nonmissing_rate"), F.count_if(t.rlike("[0-9]")).alias("with_digits"), F.count_if(F.lower(t).rlike("license")).alias("licensed"))


@query(f"WITH {SCORED}, f AS (SELECT item_id_a, bool_or(brand_relation = 'exact') AS brand_hit, bool_or(unit_relation = 'same') AS size_hit, max(nj) AS best FROM scored GROUP BY 1) SELECT count(*) AS records, round_even(avg(brand_hit::INT), 4) AS brand_rate, round_even(avg(size_hit::INT), 4) AS size_rate, count(*) FILTER (best >= 0.3) AS close FROM f")
def retrieval_quality(spark, sf_dir):
    hit = routes(spark, sf_dir).groupBy("class_a").agg(F.first("n_a").alias("n"), F.max(F.col("brand_relation") == "exact").alias("brand_hit"), F.max(F.col("unit_relation") == "same").alias("size_hit"), F.max("name_jaccard").alias("best"))
    rate = lambda c: F.bround(analysis.weighted_rate(F.col(c), "n"), 4)
    return hit.agg(analysis.weighted_count(F.lit(True), "n").alias("records"), rate("brand_hit").alias("brand_rate"), rate("size_hit").alias("size_rate"), analysis.weighted_count(F.col("best") >= 0.3, "n").alias("close"))


@query("SELECT doc_id FROM documents ORDER BY sha256('42' || doc_id::VARCHAR) LIMIT 50")
def hash_sample(spark, sf_dir):
    return analysis.sample(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 50)


@query("SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY sha256('42' || doc_id::VARCHAR)) <= 5")
def stratified_sample(spark, sf_dir):
    return analysis.sample(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", 5, by=["lang"])


@query("""WITH c AS (SELECT * FROM (VALUES ('amy s kitchen', 'amy s', 100.0), ('clif bar', 'clif', 97.0), ('good', 'good foods', 99.0), ('x', 'y', 90.0)) t(b, a, s))
  SELECT 'alias_' || replace(b, ' ', '_') AS id, 'alias' AS type, b || ' = ' || a AS title, 'Brand ''' || b || ''' is ''' || a || '''.' AS content, (s / 100)::DOUBLE AS confidence FROM c WHERE s >= 95 AND b <> 'good'""")
def knowledge_aliases(spark, sf_dir):
    schema = T.StructType([T.StructField("b_brand", T.StringType()), T.StructField("a_brand", T.StringType()), T.StructField("score", T.DoubleType())])
    return knowledge.aliases(spark.createDataFrame([("amy s kitchen", "amy s", 100.0), ("clif bar", "clif", 97.0), ("good", "good foods", 99.0), ("x", "y", 90.0)], schema))


@query("""WITH q AS (SELECT a.vec_id AS id, b.vec_id AS entry, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id % 20 = 0),
  r AS (SELECT id, score FROM q QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, entry) <= 3) SELECT id, count(*) AS n, round(max(score), 4) AS best FROM r GROUP BY 1""")
def rag_context(spark, sf_dir):
    """Entries of the query's type gathered into one context row a query."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")
    found = similarity.dense_topk(e.where("id % 20 = 0"), e, 3, same="label")
    bundle = found.groupBy("id_a").agg(F.array_sort(F.collect_list(F.struct("rank", "id_b", "score"))).alias("entries"))
    return bundle.select(F.col("id_a").alias("id"), F.size("entries").cast("long").alias("n"), F.round(F.array_max(F.transform("entries", lambda x: x["score"])), 4).alias("best"))


@query(f"WITH {PARTS} SELECT item_id, sha256('m|64|v1|' || name_norm) AS hash, 64 AS dim FROM parts")
def embed_incrementally(spark, sf_dir):
    p = catalog.parts(spark, sf_dir).select(F.col("item_id").alias("id"), knowledge.text_hash(F.col("name_norm"), "m", 64, "v1").alias("hash"), F.col("name_norm").alias("text"))
    bank = knowledge.embed(p.where("text LIKE 'red%'").select("hash", "text").dropDuplicates(["hash"]))
    done, _ = knowledge.embed_incrementally(p, bank)
    return done.select(F.col("id").alias("item_id"), "hash", F.size("vector").alias("dim"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import audit_queries  # noqa: F401 - registers its own

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from . import audit_queries  # noqa: F401 - registers its own

    return dict(_SQL)
