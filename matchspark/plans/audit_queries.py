"""Queries on the canonical build, parsers, profiling, knowledge and context, each with the SQL that DuckDB holds it against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import size, text
from ..operators import analysis, catalog, context, knowledge, matching, similarity
from .catalog_queries import BRIDGE, EVAL, GRAMS, PARTS, bridge, evaluated, jac, norm, products, query, staged, table, toks

# ---- the part table as a raw catalog ----

#: Size texts that parsers stumble on, by key.
SIZES = """CASE p_partkey % 6 WHEN 0 THEN p_size || ' oz' WHEN 1 THEN '1 ct' WHEN 2 THEN p_size || ' pk 2 lb' WHEN 3 THEN '.5 L' WHEN 4 THEN '(3 pack) ' || p_size || ' oz' ELSE '' END"""


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts in the columns of a raw catalog, some as JSON."""
    k, n = F.col("p_partkey"), F.col("p_size").cast("string")
    sized = F.when(k % 6 == 0, F.concat(n, F.lit(" oz"))).when(k % 6 == 1, "1 ct").when(k % 6 == 2, F.concat(n, F.lit(" pk 2 lb"))).when(k % 6 == 3, ".5 L").when(k % 6 == 4, F.concat(F.lit("(3 pack) "), n, F.lit(" oz"))).otherwise("")
    info = F.to_json(F.struct(F.lower(F.col("p_type")).alias("category_0"), F.when(k % 4 == 0, "Produce").otherwise("none").alias("category_1"), F.when(k % 3 == 0, F.concat(F.lit("Salt & "), "p_name")).alias("ingredients")))
    return table(spark, sf_dir, "part").select(
        k.alias("ordinal"), F.concat(F.when(k % 50 == 7, "x|").otherwise(""), k.cast("string")).alias("item_id"), "p_name", F.concat("p_name", F.when(k % 9 == 0, " Organic").otherwise("")).alias("name"), F.when(k % 4 == 1, "NaN").alias("name_clean"),
        F.when(k % 5 == 0, "Clif Bar").when(k % 5 == 1, "Great Value").otherwise(F.col("p_brand")).alias("brand_raw"), F.when(k % 2 == 0, F.concat(F.lit("A "), "p_type", F.lit(" thing."))).alias("description"),
        F.concat(F.lit("https://shop.example.com/ip/"), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("/"), k.cast("string")).alias("url"), info.alias("item_info"), F.when(k % 7 == 0, '["Fresh", "organic"]').otherwise('{"b": true, "A&b": 1, "c": false}').alias("tags"),
        F.when(k % 11 == 0, "True").alias("is_private_label"), F.to_json(F.struct(F.when(k % 2 == 0, sized).alias("size_user_friendly"))).alias("sizing_comp"), F.when(k % 2 == 1, sized).alias("size_raw"), sized.alias("size_text_of"),
    )


CANONICAL = f"""WITH r AS (SELECT *, {SIZES} AS sized, CASE WHEN p_partkey % 9 = 0 THEN p_name || ' Organic' ELSE p_name END AS name, CASE p_partkey % 5 WHEN 0 THEN 'Clif Bar' WHEN 1 THEN 'Great Value' ELSE p_brand END AS brand FROM part WHERE p_partkey % 50 <> 7),
  n AS (SELECT *, {norm("name")} AS name_norm, {norm("brand")} AS brand_norm, {norm("p_name")} AS slug, trim({norm("p_type")} || CASE WHEN p_partkey % 4 = 0 THEN ' produce' ELSE '' END) AS path, CASE WHEN p_partkey % 7 = 0 THEN 'fresh organic' ELSE 'a and b b' END AS tags_norm,
    CASE WHEN p_partkey % 2 = 0 THEN {norm("'A ' || p_type || ' thing.'")} ELSE '' END AS described, CASE WHEN p_partkey % 3 = 0 THEN {norm("'Salt & ' || p_name")} ELSE '' END AS ingredients FROM r),
  f AS (SELECT *, CASE WHEN brand_norm = 'clif bar' THEN 'clif' ELSE brand_norm END AS canonical, CASE WHEN sized = '' THEN name ELSE sized END AS size_text, brand_norm = 'great value' OR p_partkey % 11 = 0 AS private, p_partkey % 4 = 0 AS fresh,
    p_partkey % 9 = 0 OR p_partkey % 7 = 0 AS organic,
    CASE p_partkey % 6 WHEN 0 THEN p_size WHEN 1 THEN 1 WHEN 2 THEN 32 WHEN 3 THEN 16.907 WHEN 4 THEN p_size END AS unit, CASE p_partkey % 6 WHEN 2 THEN p_size WHEN 4 THEN 1 ELSE 1 END AS packs FROM n)"""
FLAG = "CASE WHEN {} THEN 'yes' ELSE 'no' END"


@query(f"""{CANONICAL} SELECT p_partkey::VARCHAR AS item_id, name_norm, canonical AS brand_canonical, slug AS url_slug_norm, path AS category_path_norm, tags_norm, size_text, private AS is_private_label_inferred, fresh AS is_food_like, fresh AS is_fresh_like, organic AS is_organic_inferred,
  trim(name_norm || ' ' || canonical || ' ' || slug || ' ' || path || ' ' || described[1:200]) AS retrieval_text FROM f""")
def canonical_catalog(spark, sf_dir):
    """Raw rows with JSON columns to canonical products: malformed ids go, names and sizes by first column that has one, flags."""
    out = catalog.canonical(raw(spark, sf_dir), "A")
    return out.select("item_id", "name_norm", "brand_canonical", "url_slug_norm", "category_path_norm", "tags_norm", "size_text", "is_private_label_inferred", "is_food_like", "is_fresh_like", "is_organic_inferred", "retrieval_text")


@query(f"""{CANONICAL} SELECT p_partkey::VARCHAR AS item_id, concat_ws(' | ', name, 'brand: ' || canonical, 'size: ' || size_text, CASE p_partkey % 6 WHEN 0 THEN 'unit: ' || p_size || ' oz' WHEN 3 THEN 'unit: 16.91 fl_oz' END, nullif('category: ' || path, 'category: '), 'url_slug: ' || slug,
  'flags: private_label=' || {FLAG.format("private")} || ' organic=' || {FLAG.format("organic")} || ' food=' || {FLAG.format("fresh")} || ' fresh=' || {FLAG.format("fresh")}, nullif('ingredients: ' || ingredients[1:300], 'ingredients: '), nullif('description: ' || described[1:200], 'description: ')) AS embedding_text
  FROM f WHERE p_partkey % 6 IN (0, 3, 5)""")
def embedding_texts(spark, sf_dir):
    """The labelled text of each canonical product that has one plain size or none."""
    return catalog.canonical(raw(spark, sf_dir), "A").where("item_id % 6 IN (0, 3, 5)").select("item_id", "embedding_text")


def sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw(spark, sf_dir).select("ordinal", F.when(F.col("ordinal") % 2 == 0, "A").otherwise("B").alias("store_id"), "name", F.col("size_text_of").alias("size_source"))
    rows = rows.withColumn("name", F.concat("name", F.lit(" "), "size_source"))
    return rows.withColumns({"old": size.plain_size(F.col("size_source")), "new": size.probe_size(F.col("size_source"))}).select("*", "old.*", "new.*").drop("old", "new")


PARSED = f"""p AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'A' ELSE 'B' END AS store_id, {SIZES} AS size_source,
    CASE p_partkey % 6 WHEN 0 THEN 'weight:' || p_size WHEN 1 THEN 'count:1' WHEN 2 THEN 'weight:' || 32 * p_size WHEN 3 THEN 'volume:169' WHEN 4 THEN 'weight:' || p_size ELSE '' END AS size_bucket,
    CASE p_partkey % 6 WHEN 0 THEN 'weight:' || p_size WHEN 2 THEN 'weight:32' WHEN 3 THEN 'volume:17' WHEN 4 THEN 'weight:' || p_size ELSE '' END AS unit_bucket,
    CASE p_partkey % 6 WHEN 0 THEN 'weight:' || p_size WHEN 2 THEN 'weight:' || 32 * p_size WHEN 3 THEN 'volume:17' WHEN 4 THEN 'weight:' || 3 * p_size ELSE '' END AS total_bucket,
    CASE p_partkey % 6 WHEN 2 THEN p_size WHEN 4 THEN 3 ELSE 1 END AS pack_count FROM part)"""


@query(f"WITH {PARSED} SELECT p_partkey, size_bucket, unit_bucket, total_bucket, pack_count FROM p")
def size_parsers(spark, sf_dir):
    """The first parser's bucket and its successor's."""
    return sized(spark, sf_dir).select(F.col("ordinal").alias("p_partkey"), "size_bucket", "unit_bucket", "total_bucket", "pack_count")


@query(f"""WITH {PARSED} SELECT store_id, count(*) AS rows, count(*) FILTER (p_partkey % 6 IN (1, 2, 4)) AS multipack_in_name, count(*) FILTER (p_partkey % 6 IN (1, 2, 4)) AS multipack_in_source, count(*) FILTER (p_partkey % 6 = 3) AS leading_decimal, count(*) FILTER (size_bucket = 'count:1') AS trivial_count,
  count(*) FILTER (p_partkey % 6 IN (2, 4)) AS multipack_unaccounted, 0::BIGINT AS leading_decimal_unparsed, count(*) FILTER (size_bucket = '') AS bucket_empty FROM p GROUP BY 1""")
def parser_audit(spark, sf_dir):
    return analysis.parser_audit(sized(spark, sf_dir))


@query(f"""WITH {PARSED}, i AS (SELECT *, CASE WHEN p_partkey % 6 IN (2, 4) THEN 'multipack_unaccounted' WHEN size_bucket = 'count:1' THEN 'trivial_count' END AS issue FROM p)
  SELECT store_id, issue, p_partkey FROM i WHERE issue IS NOT NULL QUALIFY row_number() OVER (PARTITION BY store_id, issue ORDER BY p_partkey) <= 15""")
def parser_failures(spark, sf_dir):
    return analysis.parser_failures(sized(spark, sf_dir), "ordinal").select("store_id", "issue", F.col("ordinal").alias("p_partkey"))


@query(f"""WITH {PARSED} SELECT store_id, count(*) AS rows, count(*) FILTER (size_bucket <> '') AS old_nonempty, count(*) FILTER (unit_bucket <> '') AS unit_nonempty, count(*) FILTER (total_bucket <> '') AS total_nonempty, count(*) FILTER (size_bucket = '' AND unit_bucket <> '') AS recovered,
  count(*) FILTER (size_bucket = 'count:1' AND unit_bucket = '') AS count1_removed, count(*) FILTER (pack_count > 1 AND unit_bucket <> '') AS multipack_with_unit, count(*) FILTER (size_bucket <> unit_bucket AND unit_bucket <> '') AS changed FROM p GROUP BY 1""")
def parser_deltas(spark, sf_dir):
    return analysis.parser_deltas(sized(spark, sf_dir))


@query(f"""WITH {PARSED} SELECT p_partkey, p_partkey % 6 IN (1, 2, 4) AS multipack, p_partkey % 6 = 3 AS leading, p_partkey % 6 = 1 AS trivial, printf('%.1f%%', 100.0 * (p_partkey % 8) / 8) AS share, p_partkey % 3 = 1 AS said FROM p""")
def size_shapes(spark, sf_dir):
    """Shapes that parsers stumble on, a percentage, and a flag read from text."""
    rows, k = sized(spark, sf_dir), F.col("ordinal")
    s = F.col("size_source")
    said = F.when(k % 3 == 1, "Yes ").when(k % 3 == 0, "no")
    return rows.select(k.alias("p_partkey"), text.shape(s, text.MULTIPACK).alias("multipack"), text.shape(s, text.LEADING_DECIMAL).alias("leading"), text.shape(s, text.TRIVIAL_COUNT).alias("trivial"), size.percent(k % 8, F.lit(8)).alias("share"), text.parse_bool(said).alias("said"))


@query(f"SELECT p_partkey, {norm("p_name || ' ' || p_brand || ' ' || p_type")} AS match_text, trim({norm('p_type')} || ' ' || {norm('p_name')}) AS path, CASE WHEN p_partkey % 2 = 0 THEN p_name WHEN p_partkey % 3 = 0 THEN p_brand ELSE p_type END AS best FROM part")
def match_texts(spark, sf_dir):
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    best = context.best_category(F.when(k % 2 == 0, F.col("p_name")), F.when(k % 3 == 0, F.col("p_brand")).otherwise("nan"), F.col("p_type"))
    return p.select("p_partkey", text.match_text(F.col("p_name"), F.col("p_brand"), F.lit(None).cast("string"), F.col("p_type")).alias("match_text"), text.category_path(F.col("p_type"), F.lit("NULL"), F.col("p_name")).alias("path"), best.alias("best"))


# ---- joins and projections ----


@query("SELECT o_orderkey, o_custkey, EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_suppkey = o.o_custkey % 10) AS shipped FROM orders o")
def shipped_flags(spark, sf_dir):
    """Whether each asked pair is among the shipped ones."""
    asked = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderkey").alias("a"), (F.col("o_custkey") % 10).alias("b"))
    shipped = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("a"), F.col("l_suppkey").alias("b"))
    return matching.flag_pairs(asked, shipped, ["a", "b"], "shipped").drop("a", "b")


SLUGS = f"""s AS (SELECT page_id, page_id % 2 AS side, regexp_extract(url, '^[a-z]+://[^/]*/([a-z]+)', 1) AS block, {toks(norm("regexp_replace(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), '[.]', ' ', 'g')"))} AS all_t FROM pages),
  t AS (SELECT *, list_filter(all_t, lambda x: len(x) > 1) AS t FROM s)"""


@query(f"""WITH {SLUGS}, j AS (SELECT a.page_id AS id_a, b.page_id AS id_b, {jac("a.t", "b.t")} AS score FROM t a JOIN t b ON a.block = b.block AND a.side = 0 AND b.side = 1)
  SELECT id_a, id_b, round_even(score, 4) AS score FROM j WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY id_a ORDER BY score DESC, id_b) = 1""")
def slug_overlap(spark, sf_dir):
    """The page of the other side whose address has most tokens in common, within a language."""
    host = F.regexp_replace(F.regexp_extract("url", r"^[a-z]+://([^/?#]*)", 1), "[.]", " ")
    p = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", r"^[a-z]+://[^/]*/([a-z]+)", 1).alias("block"), text.slug_tokens(host).alias("t"))
    a, b = (p.where(F.col("page_id") % 2 == i).select(F.col("page_id").alias(f"id_{s}"), "block", F.col("t").alias(f"t_{s}")) for i, s in ((0, "a"), (1, "b")))
    return matching.best_overlap(a, b, "block").withColumn("score", F.bround("score", 4))


@query(f"""WITH corpus AS (SELECT p_partkey::VARCHAR AS id, {norm("p_name || ' ' || p_type")} AS text FROM part), {GRAMS.replace("0.6 * n", "0.5 * n").replace("norms AS (SELECT id, sqrt(sum(w * w)) AS norm FROM x GROUP BY 1), v AS (SELECT id, term, w / norm AS w FROM x JOIN norms USING (id))", "own AS (SELECT id, term[1:1] AS kind, sqrt(sum(w * w)) AS norm FROM x GROUP BY 1, 2), y AS (SELECT x.id, x.term, x.w / own.norm AS w FROM x JOIN own ON x.id = own.id AND x.term[1:1] = own.kind), norms AS (SELECT id, sqrt(sum(w * w)) AS norm FROM y GROUP BY 1), v AS (SELECT id, term, w / norm AS w FROM y JOIN norms USING (id))")},
  dots AS (SELECT a.id AS id_a, b.id AS id_b, round(sum(a.w * b.w), 6) AS score FROM v a JOIN v b USING (term) WHERE a.id::BIGINT % 2 = 0 AND b.id::BIGINT % 2 = 1 GROUP BY 1, 2),
  best AS (SELECT * FROM dots WHERE score >= 0.4 QUALIFY row_number() OVER (PARTITION BY id_a ORDER BY score DESC, id_b) = 1),
  f AS (SELECT best.*, a.p_brand = b.p_brand AS brand, a.p_size = b.p_size AS size FROM best JOIN part a ON a.p_partkey = id_a::BIGINT JOIN part b ON b.p_partkey = id_b::BIGINT)
  SELECT count(*) FILTER (score >= 0.6) AS high, count(*) FILTER (score >= 0.6 AND brand) AS high_brand, count(*) FILTER (score >= 0.6 AND size) AS high_size, count(*) FILTER (score >= 0.6 AND brand AND size) AS high_both, count(*) FILTER (score < 0.6) AS middle FROM f""")
def tfidf_projection(spark, sf_dir):
    """Best partners by TF-IDF whose kinds of terms weigh alike, counted by cosine, brand and size."""
    p = table(spark, sf_dir, "part")
    rows = p.select(F.col("p_partkey").cast("string").alias("id"), text.normalize(F.concat_ws(" ", "p_name", "p_type")).alias("text"), "p_brand", "p_size")
    a, b = (rows.where(F.col("id").cast("long") % 2 == i) for i in (0, 1))
    best = similarity.sparse_topk(a.select("id", "text"), b.select("id", "text"), 1, 0.4, max_share=0.5, per_kind=True)
    told = best.join(a.select(F.col("id").alias("id_a"), F.col("p_brand").alias("ba"), F.col("p_size").alias("sa")), "id_a").join(b.select(F.col("id").alias("id_b"), F.col("p_brand").alias("bb"), F.col("p_size").alias("sb")), "id_b")
    high, brand, same = F.col("score") >= 0.6, F.col("ba") == F.col("bb"), F.col("sa") == F.col("sb")
    return told.agg(F.count_if(high).alias("high"), F.count_if(high & brand).alias("high_brand"), F.count_if(high & same).alias("high_size"), F.count_if(high & brand & same).alias("high_both"), F.count_if(~high).alias("middle"))


@query(f"WITH {PARTS}, a AS (SELECT brand, count(*) AS n FROM parts WHERE store_id = 'A' GROUP BY 1), b AS (SELECT brand, count(*) AS n FROM parts WHERE store_id = 'B' GROUP BY 1) SELECT a.brand, a.n AS count_a, b.n AS count_b FROM a JOIN b USING (brand) ORDER BY a.n + b.n DESC, a.brand LIMIT 10")
def top_shared(spark, sf_dir):
    p = catalog.parts(spark, sf_dir)
    return analysis.top_shared(p.where("store_id = 'A'"), p.where("store_id = 'B'"), "brand", 10)


# ---- evaluation ----

ANSWERS = "e AS (SELECT l.quality = 1 AS truth, d.n_chars > 1500 AS guess, d.doc_id % 7 <> 0 AS json_valid, CASE WHEN l.quality = 1 THEN 'x' ELSE 'y' END AS truth_type, CASE WHEN d.doc_id % 2 = 0 THEN 'x' ELSE 'y' END AS guess_type, d.n_chars AS prompt_tokens, d.doc_id % 50 AS completion_tokens FROM labels l JOIN documents d USING (doc_id))"
TOLD = "count(*) AS n, count(*) FILTER (truth AND guess) AS tp, count(*) FILTER (NOT truth AND guess) AS fp, count(*) FILTER (truth AND NOT guess) AS fn, count(*) FILTER (NOT truth AND NOT guess) AS tn"
EXACT = "SELECT *, tp / nullif(tp + fp, 0)::DOUBLE AS p, tp / nullif(tp + fn, 0)::DOUBLE AS r FROM c"


@query(f"WITH {EVAL}, c AS (SELECT lang, {TOLD} FROM e GROUP BY 1), x AS ({EXACT}) SELECT lang, n, tp, fp, fn, tn, round_even(p, 4) AS precision, round_even(r, 4) AS recall, CASE WHEN p > 0 AND r > 0 THEN round_even(2 * p * r / (p + r), 4) END AS f1 FROM x")
def exact_metrics(spark, sf_dir):
    """f1 of the unrounded precision and recall."""
    return analysis.metrics(evaluated(spark, sf_dir), "truth", "guess", by=["lang"])


@query(f"""WITH {ANSWERS}, c AS (SELECT {TOLD} FROM e WHERE json_valid), x AS ({EXACT}), a AS (SELECT round_even(avg(json_valid::INT), 4) AS valid_rate, sum(prompt_tokens)::BIGINT AS prompt, sum(completion_tokens)::BIGINT AS completion, round_even(avg((truth = guess)::INT) FILTER (json_valid), 4) AS match_accuracy,
  round_even(avg((truth_type = guess_type)::INT) FILTER (json_valid), 4) AS type_accuracy FROM e)
  SELECT a.*, round(prompt / 1000000 * 0.25::DOUBLE + completion / 1000000 * 2.0::DOUBLE, 6) AS cost, n, tp, fp, fn, tn, coalesce(round_even(p, 4), 0) AS precision, coalesce(round_even(r, 4), 0) AS recall, coalesce(round_even(2 * p * r / nullif(p + r, 0), 4), 0) AS f1 FROM a, x""")
def benchmark_report(spark, sf_dir):
    d, k = table(spark, sf_dir, "documents"), F.col("doc_id")
    yes = F.col("quality") == 1
    e = table(spark, sf_dir, "labels").join(d, "doc_id").select(yes.alias("truth"), (F.col("n_chars") > 1500).alias("guess"), (k % 7 != 0).alias("json_valid"), F.when(yes, "x").otherwise("y").alias("truth_type"), F.when(k % 2 == 0, "x").otherwise("y").alias("guess_type"), F.col("n_chars").alias("prompt_tokens"), (k % 50).alias("completion_tokens"))
    return analysis.benchmark_report(e, 0.25, 2.0)


@query("SELECT count(*) AS rows, count(text) AS nonmissing, round_even(count(text) / count(*)::DOUBLE, 4) AS coverage, count(*) FILTER (regexp_matches(text, '[0-9]{4}')) AS digits, count(*) FILTER (regexp_matches(lower(text), 'license|token')) AS words, floor(quantile_cont(length(text), 0.5))::BIGINT AS len_p50, floor(quantile_cont(length(text), 0.9))::BIGINT AS len_p90, floor(quantile_cont(length(text), 0.99))::BIGINT AS len_p99 FROM documents")
def description_signals(spark, sf_dir):
    return analysis.signal_stats(table(spark, sf_dir, "documents"), "text", {"digits": "[0-9]{4}", "words": "(?i)license|token"})


@query("SELECT 'prop_k' AS field, round_even(avg((props->>'$.k' IS NOT NULL)::INT), 4) AS coverage FROM events UNION ALL SELECT 'prop_z', round_even(avg((props->>'$.z' IS NOT NULL)::INT), 4) FROM events")
def nested_coverage(spark, sf_dir):
    return analysis.field_coverage(catalog.nested(table(spark, sf_dir, "events"), "props", ["k", "z"], "prop"), ["prop_k", "prop_z"])


@query(f"""WITH t AS (SELECT list_filter({toks(norm("p_name || ' ' || p_type || ' ' || p_brand"))}, lambda x: len(x) > 1) AS more, {toks(norm("p_name"))} AS than FROM part), n AS (SELECT len(list_filter(more, lambda x: NOT list_contains(than, x))) AS n FROM t)
  SELECT count(*) AS rows, round_even(avg(n), 3) AS mean_extra, round_even(quantile_cont(n, 0.5), 3)::DOUBLE AS p50_extra, round_even(quantile_cont(n, 0.9), 3)::DOUBLE AS p90_extra, count(*) FILTER (n > 0) AS rows_with_extra FROM n""")
def extra_tokens(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(text.slug_tokens(F.concat_ws("-", "p_name", "p_type", "p_brand")).alias("more"), text.tokens(text.normalize(F.col("p_name"))).alias("than"))
    return analysis.extra_tokens(p, F.col("more"), F.col("than"))


@query("SELECT coalesce(event_type, 'total') AS event_type, count(*) AS n FROM events GROUP BY ROLLUP (event_type)")
def type_totals(spark, sf_dir):
    return analysis.totals(table(spark, sf_dir, "events"), "event_type")


STRATA = "SELECT doc_id, '{name}' AS stratum FROM documents WHERE {cond} ORDER BY sha256('42' || doc_id::VARCHAR) LIMIT {n}"


@query(f"""WITH s AS (SELECT * FROM ({STRATA.format(name="long", cond="n_chars >= 3000", n=20)}) UNION ALL SELECT * FROM ({STRATA.format(name="middle", cond="n_chars >= 1000 AND n_chars < 3000", n=12)}) UNION ALL SELECT * FROM ({STRATA.format(name="german", cond="lang = 'de'", n=3)})
    UNION ALL SELECT -1, 'hand' UNION ALL SELECT -2, 'hand')
  SELECT 'P' || lpad((row_number() OVER (ORDER BY stratum, doc_id) - 1)::VARCHAR, 4, '0') AS pair_id, doc_id, stratum FROM s""")
def evaluation_set(spark, sf_dir):
    """Samples of strata of several sizes and score bands, with rows made by hand, under running keys."""
    n = F.col("n_chars")
    drawn = analysis.stratified(table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang"), "doc_id", {"long": (n >= 3000, 20), "middle": ((n >= 1000) & (n < 3000), 12), "german": (F.col("lang") == "de", 3)})
    hand = spark.createDataFrame([(-1, "hand"), (-2, "hand")], "doc_id long, stratum string")
    return analysis.surrogate_keys(drawn.select("doc_id", "stratum").unionByName(hand), ["stratum", "doc_id"]).select("pair_id", "doc_id", "stratum")


# ---- knowledge and context ----

WIDE = "w AS (SELECT a_category, support, rank, b_category, share FROM bridge WHERE support >= 1)"


@query(f"WITH {PARTS}, {BRIDGE}, {WIDE} SELECT a_category, string_agg(b_category || ' (share=' || printf('%.2f', share) || ')', '; ' ORDER BY rank) AS hint FROM w GROUP BY 1")
def bridge_hints(spark, sf_dir):
    """A category's three first targets as a line, from the wide table."""
    return context.bridge_hints(context.sure_targets(context.wide_bridge(bridge(spark, sf_dir), "a_cat0"), 1))


@query(f"WITH {PARTS}, {BRIDGE}, {WIDE}, k AS (SELECT * FROM w WHERE share >= 0.2 AND support >= 2 QUALIFY row_number() OVER (PARTITION BY a_category ORDER BY rank) <= 2) SELECT 'bridge_' || replace(a_category, ' ', '_') AS id, max(share) AS confidence, count(*) AS targets FROM k GROUP BY a_category")
def bridge_entries(spark, sf_dir):
    e = context.bridge_entries(context.wide_bridge(bridge(spark, sf_dir), "a_cat0"), 2, 0.2)
    return e.select("id", "confidence", F.size(F.split("content", "; ")).cast("long").alias("targets"))


def labelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents of a label beside their neighbours, as pairs with labels."""
    l, k = table(spark, sf_dir, "labels"), F.format_string("%06d", F.col("doc_id"))
    side = lambda s: [F.concat(F.lit(f"{s}"), k).alias(f"name_{s}"), F.lit("b").alias(f"brand_{s}"), F.lit("1 oz").alias(f"size_{s}"), F.lit(None).cast("string").alias(f"category_{s}")]
    return l.select(k.alias("pair_id"), *side("a"), *side("b")), l.select(k.alias("pair_id"), F.when(F.col("quality") == 1, "True").otherwise("False").alias("is_match"), F.lit("exact").alias("match_type"), F.lit(0.9).alias("confidence"), F.lit("n").alias("notes"))


SIDES = "'A: name=''a' || k || ''', brand=''b'', size=''1 oz'', category=''''. B: name=''b' || k || ''', brand=''b'', size=''1 oz'', category=''''. Reason: n'"


@query(f"WITH l AS (SELECT printf('%06d', doc_id) AS k, quality = 1 AS yes FROM labels) SELECT CASE WHEN yes THEN 'acc_' ELSE 'rej_' END || k AS id, CASE WHEN yes THEN 'accepted_example' ELSE 'rejected_example' END AS type, {SIDES} AS content, CASE WHEN yes THEN 'exact' END AS match_type FROM l")
def example_entries(spark, sf_dir):
    return context.example_entries(*labelled(spark, sf_dir)).select("id", "type", "content", "match_type")


@query("WITH l AS (SELECT printf('%06d', doc_id) AS k, quality = 1 AS yes FROM labels QUALIFY row_number() OVER (PARTITION BY quality ORDER BY printf('%06d', doc_id)) <= 25) SELECT CASE WHEN yes THEN 'acc_' ELSE 'rej_' END || k AS id, CASE WHEN yes THEN 'ACCEPTED' ELSE 'REJECTED' END || ' example' AS title, 'A: a' || k || ' / brand b / size 1 oz | B: b' || k || ' / brand b / size 1 oz. Reason: n' AS content FROM l")
def example_snippets(spark, sf_dir):
    return context.example_snippets(*labelled(spark, sf_dir))


@query("""WITH l AS (SELECT printf('%06d', doc_id) AS k FROM labels) SELECT k AS pair_id, 'Store A product:' || chr(10) || '  name: a' || k || chr(10) || '  brand: b' || chr(10) || '  size: 1 oz' || chr(10) || '  category: ' || chr(10) || 'Store B product:' || chr(10) || '  name: b' || k || chr(10) || '  brand: b' || chr(10) || '  size: 1 oz' || chr(10) || '  category: ' || chr(10) AS prompt FROM l""")
def pair_prompts(spark, sf_dir):
    pairs, _ = labelled(spark, sf_dir)
    return pairs.select("pair_id", context.pair_prompt(pairs).alias("prompt"))


def asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record's five first block partners by id, as context.build() wants them."""
    a, b = catalog.sides(spark, sf_dir, *matching.BLOCKED, "name", "brand_norm", "size_text", "category_norm")
    rows = matching.classed(a, "a", matching.BLOCKED).join(matching.block_firsts(a, b, 5, matching.BLOCKED), "class_a")
    return rows.select("item_id_a", "item_id_b", "rank", *[F.col(f"{c}_{s}").alias(f"{n}_{s}") for s in "ab" for c, n in (("name", "name"), ("brand_norm", "brand"), ("size_text", "size"), ("category_norm", "category"))])


ASKED = f"""WITH {PARTS}, k AS (SELECT x.*, a.name AS an, a.brand_norm AS ab, a.size_text AS asz, b.name AS bn, b.brand_norm AS bb, b.size_text AS bs, a.category_norm AS ac, row_number() OVER (PARTITION BY x.item_id_a ORDER BY x.item_id_b) AS rank FROM blocked x JOIN sized a ON a.item_id = x.item_id_a JOIN sized b ON b.item_id = x.item_id_b QUALIFY rank <= 5)"""


@query(f"{ASKED} SELECT item_id_a, 'A: ' || any_value(an) || ' brand ' || any_value(ab) || ' size ' || any_value(asz) || '. B candidates: ' || string_agg(bn || ' (' || bb || ', ' || bs || ')', ' | ' ORDER BY rank) AS query FROM k GROUP BY 1")
def query_texts(spark, sf_dir):
    return context.query_text(asked(spark, sf_dir))


@query(f"""{ASKED.replace("WITH ", "WITH ", 1)}, c AS (SELECT *, CASE ab WHEN 'brand 1' THEN 'brand 2' WHEN 'brand 4' THEN 'brand 5' ELSE ab END = CASE bb WHEN 'brand 1' THEN 'brand 2' WHEN 'brand 4' THEN 'brand 5' ELSE bb END AS same FROM k)
  SELECT item_id_a, string_agg((rank - 1) || ':' || ab || ':' || bb || ':' || same, ',' ORDER BY rank) AS checks FROM c GROUP BY 1""")
def alias_checks(spark, sf_dir):
    found = context.alias_checks(asked(spark, sf_dir), {"brand 1": "brand 2", "brand 4": "brand 5"})
    return found.select("item_id_a", F.array_join(F.transform("aliases", lambda x: F.concat_ws(":", x["b_index"].cast("string"), x["a_brand"], x["b_brand"], x["are_aliases"].cast("string"))), ",").alias("checks"))


@query()
def context_bundle(spark, sf_dir):
    """The context of each record: knowledge made from labels and the category map, indexed, searched by type, with alias checks and a category hint, as a prompt block."""
    wide = context.wide_bridge(bridge(spark, sf_dir), "a_cat0")
    rules = context.entries(table(spark, sf_dir, "benchmark"), F.concat(F.lit("rule_"), F.col("item_id").cast("string")), "rule", F.lit("Rule"), F.col("text"), F.lit(1.0))
    every = context.bootstrap(rules, context.example_entries(*labelled(spark, sf_dir)), context.bridge_entries(wide, 2, 0.2))
    bank = spark.createDataFrame([], "hash string, vector array<float>")
    indexed, _ = context.index(staged(every), bank)
    indexed, rows = staged(indexed), staged(asked(spark, sf_dir))  # each is searched for every type
    out = context.build(rows, indexed, context.sure_targets(wide, 1), rows.where("rank = 1").select("item_id_a", F.col("category_a").alias("category")), keep=staged)
    return out.select("item_id_a", context.prompt_block().alias("block"), context.context_signature().alias("signature"))


TINY = f"""d AS (SELECT 'b' || item_id AS id, list_filter(regexp_extract_all(lower(regexp_replace(text, '[^ -~]', ' ', 'g')), '[a-z0-9_]+'), lambda x: len(x) > 1) AS w FROM benchmark UNION ALL SELECT 'd' || doc_id, list_filter(regexp_extract_all(lower(regexp_replace(text, '[^ -~]', ' ', 'g')), '[a-z0-9_]+'), lambda x: len(x) > 1) FROM documents WHERE doc_id % 20 = 0),
  g AS (SELECT id, unnest(list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM d), tf AS (SELECT id, term, count(*) AS tf FROM g GROUP BY 1, 2),
  df AS (SELECT term, count(*) AS df FROM tf WHERE id[1] = 'b' GROUP BY 1), n AS (SELECT count(*) AS n FROM benchmark),
  x AS (SELECT id, term, (1 + ln(tf)) * (ln((1 + n) / (1 + df)::DOUBLE) + 1) AS w FROM tf JOIN df USING (term), n), norms AS (SELECT id, sqrt(sum(w * w)) AS norm FROM x GROUP BY 1), v AS (SELECT id, term, w / norm AS w FROM x JOIN norms USING (id)),
  s AS (SELECT a.id AS id_a, b.id AS id_b, round(sum(a.w * b.w), 6) AS score FROM v a JOIN v b USING (term) WHERE a.id[1] = 'd' AND b.id[1] = 'b' GROUP BY 1, 2)"""


@query(f"WITH {TINY} SELECT id_a, id_b, rank, score FROM (SELECT *, row_number() OVER (PARTITION BY id_a ORDER BY score DESC, id_b) AS rank FROM s WHERE score > 0) WHERE rank <= 3")
def tiny_search(spark, sf_dir):
    """Rules looked up by words: queries are the documents whose id is divisible by 20."""
    plain = F.regexp_replace("text", "[^ -~]", " ")
    rules = table(spark, sf_dir, "benchmark").select(F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("id"), plain.alias("text"))
    asked_ = table(spark, sf_dir, "documents").where("doc_id % 20 = 0").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), plain.alias("text"))
    return context.tiny_search(asked_, rules).select("id_a", "id_b", "rank", "score")


@query()
def model_benchmark(spark, sf_dir):
    """The offline judge over block pairs one by one, against blocks' own relations: one row of rates, tokens and cost. Pairs alike in all columns are one request, counted as often as they stand."""
    f = products(spark, sf_dir, "name").withColumns({"request": F.concat_ws("|", "first_a", "first_b"), "same": F.col("unit_relation") == "same"})
    one = knowledge.judge(f.select(F.col("request").alias("item_id_a"), F.col("first_b").alias("item_id_b"), "final_score"), k=1)
    truth = f.select(F.col("request").alias("item_id_a"), F.col("same").alias("truth"), F.when(F.col("same"), "exact_national_brand").otherwise("no_match").alias("truth_type"), F.length(F.concat("name_a", "name_b")).alias("prompt_tokens"), "pairs")
    rows = one.join(truth, "item_id_a").select("json_valid", "truth", F.col("is_match").alias("guess"), "truth_type", F.col("match_type").alias("guess_type"), "prompt_tokens", F.length("raw_response").alias("completion_tokens"), "pairs")
    return analysis.benchmark_report(rows, 0.25, 2.0, "pairs")
