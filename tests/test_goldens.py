"""Published results as fixtures: scores and routes from features, ratios of names, sizes, slugs and evaluation counts."""

import csv
import pathlib

import pytest
from pyspark.sql import functions as F

from matchspark.functions import flags, fuzzy, size, text
from matchspark.operators import analysis, catalog, context, knowledge, matching
from matchspark.plans import audit_queries, catalog_queries
from matchspark.sources import tables

SF = "/root/testdata/sf0.001"


def fixture(spark, name):
    with (pathlib.Path(__file__).parent / "fixtures" / f"{name}.csv").open() as f:
        found = list(csv.DictReader(f))
    return spark.createDataFrame([tuple(r.values()) for r in found], [*found[0]] and ", ".join(f"{c} string" for c in found[0]))


def test_scores_and_routes(spark):
    d = lambda c: F.expr(f"try_cast({c} as double)")
    c, none = F.col, F.lit("")
    rows = fixture(spark, "scores")
    score = flags.final_score(c("brand"), c("unit"), c("total"), d("fuzzy"), d("cosine"), d("categories"), none)
    got = rows.select(score.alias("score"), d("final_score").alias("want"), flags.route(c("brand"), c("unit"), d("fuzzy"), d("cosine"), none, c("source")).alias("got_route"), "route").collect()
    assert len(got) == 88
    assert all(abs(r.score - r.want) < 1e-9 for r in got)
    assert sum(r.got_route == r.route for r in got if r.route) == 38


def test_name_ratios(spark):
    rows = fixture(spark, "ratios").withColumns({"a": text.normalize(F.col("name_a")), "b": text.normalize(F.col("name_b"))})
    j = F.bround(text.jaccard(text.tokens(F.col("a"), 1), text.tokens(F.col("b"), 1)), 4)
    got = rows.select(fuzzy.wratio_udf("a", "b").alias("r"), F.col("ratio").cast("double").alias("want"), j.alias("j"), F.col("jaccard").cast("double").alias("want_j")).collect()
    assert len(got) == 86
    assert all(abs(r.r - r.want) < 0.01 and abs(r.j - r.want_j) < 1e-4 for r in got)


def test_slug_overlaps(spark):
    rows = fixture(spark, "slugs")
    got = rows.select(F.bround(text.jaccard(text.slug_tokens(F.col("slug_a")), text.slug_tokens(F.col("slug_b"))), 4).alias("j"), F.col("jaccard").cast("double").alias("want")).collect()
    assert len(got) == 56
    assert all(abs(r.j - r.want) < 1e-4 for r in got)


def test_size_buckets(spark):
    rows = fixture(spark, "sizes")
    got = rows.select(size.plain_size(text.first_present(F.col("size"), F.col("name"))).getField("size_bucket").alias("got"), "bucket", "size", "name").collect()
    assert len(got) == 160
    off = [r for r in got if r.got != (r.bucket or "")]
    assert len(off) <= 1, off  # halves that binary rounding moves


def test_evaluation_counts(spark):
    rows = fixture(spark, "pairs").select(text.parse_bool(F.col("label_is_match")).alias("truth"), text.parse_bool(F.col("shipped")).alias("guess"))
    r = analysis.confusion(rows, "truth", "guess").first()
    assert (r.n, r.tp, r.fp, r.fn, r.tn, r.precision, r.recall, r.f1) == (97, 32, 6, 9, 50, 0.8421, 0.7805, 0.8101)
    e = analysis.metrics(rows, "truth", "guess").first()
    assert (e.precision, e.recall, e.f1) == (0.8421, 0.7805, 0.8101)


@pytest.mark.parametrize(("a", "b", "want"), [(("", "", True), ("x", "x", True), "unknown"), (("x", "x", False), ("x", "x", False), "exact"), (("x y", "x", False), ("x", "x", False), "alias"), (("p", "p", True), ("q", "q", True), "private_label_compatible"), (("p", "p", True), ("q", "q", False), "conflict")])
def test_brand_relations(spark, a, b, want):
    df = spark.createDataFrame([(*a, *b)], "ra string, a string, pa boolean, rb string, b string, pb boolean")
    assert df.select(flags.brand_relation(*(F.col(c) for c in df.columns))).first()[0] == want


def test_record_flags(spark):
    df = spark.createDataFrame([("A", "great value", None, []), ("A", "x", "True", []), ("A", "x", "false", []), ("B", "wegmansy", None, []), ("B", "x", None, ["Wegmans_Brand"]), ("B", "x", "true", [])], "s string, b string, f string, t array<string>")
    assert [r[0] for r in df.select(flags.private_label(*(F.col(c) for c in df.columns))).collect()] == [True, True, False, True, True, False]
    one = spark.createDataFrame([("soft produce here", "organic tea", "", None), ("pet toys", "tea", "", "yes")], "path string, name string, tags string, flag string")
    t = lambda c: text.tokens(F.col(c))
    got = one.select(flags.food_like(t("path")), flags.fresh_like(t("path")), flags.organic(t("name"), t("tags"), F.col("flag"))).collect()
    assert [tuple(r) for r in got] == [(True, True, True), (False, False, True)]
    soft = spark.createDataFrame([(True, False, True), (True, False, False), (True, True, True)], "a boolean, b boolean, f boolean")
    assert [r[0] for r in soft.select(flags.organic_relation(F.col("a"), F.col("b"), F.col("f"))).collect()] == ["conflict", "soft_conflict", "match"]
    veto = flags.veto_reasons(*(F.lit(x) for x in ("conflict", "conflict_dim", True, True, "conflict")))
    assert df.select(veto).first()[0] == "brand_conflict,size_dim_conflict,flavor_conflict,form_conflict,organic_conflict"


def test_probe_sizes(spark):
    given = {"(3 pack) Mix, 15.25 oz": ("weight:15", "weight:46", 3), ".5 L": ("volume:17", "volume:17", 1), "1 ct": ("", "", 1), "pack of 6 12 fl oz": ("volume:12", "volume:72", 6), "24 ct cans": ("count:24", "count:24", 24), "101 pack 2 oz": ("weight:2", "weight:2", 1), "": ("", "", 1)}
    rows = spark.createDataFrame([(x,) for x in given], "t string").select("t", size.probe_size(F.col("t")).alias("s")).collect()
    assert {r.t: (r.s.unit_bucket, r.s.total_bucket, r.s.pack_count) for r in rows} == given


def side(spark, rows, s):
    cols = ("item_id", "brand", "name_norm", "unit_bucket", "total_bucket", "category_norm", "is_private_label")
    return spark.createDataFrame(rows, ", ".join(f"{c}_{s} {'boolean' if c.startswith('is_') else 'string'}" for c in cols))


def test_best_of_blocks_equal_all_pairs(spark):
    r = __import__("random").Random(3)
    words = ["sharp", "cheddar", "cheese", "block", "milk", "whole", "oat", "bar"]
    make = lambda i, s: (f"{s}{i}", r.choice(["x", "y", ""]), " ".join(r.choices(words, k=r.randint(1, 4))), r.choice(["w:1", "w:2", ""]), r.choice(["w:1", "w:2", "w:4"]), r.choice(["c", "d"]), r.random() < 0.6)
    a, b = [make(i, "a") for i in range(40)], [make(i, "b") for i in range(60)]
    da, db = side(spark, a, "a"), side(spark, b, "b")

    def best(fits, k, least):
        out = set()
        for x in a:
            found = sorted((-round(fuzzy.weighted_ratio(x[2], y[2]), 6), y[0]) for y in b if fits(x, y) and {x[3], x[4]} & {y[3], y[4]} - {""})
            out |= {(x[0], i, -s) for s, i in found[:k] if -s >= least}
        return out

    assert {tuple(x) for x in matching.strict_block_top(da, db).collect()} == best(lambda x, y: x[1] == y[1] != "", 3, 0)
    bridge = spark.createDataFrame([("c", "d", 20, 0.5), ("d", "d", 20, 0.05), ("c", "c", 5, 0.9), ("d", "c", 10, 0.1)], "a_category string, b_category string, support long, share double")
    assert {tuple(x) for x in matching.private_label_top(da, db, bridge).collect()} == best(lambda x, y: x[6] and y[6] and (x[5], y[5]) in {("c", "d"), ("d", "c")}, 5, 60)


def test_stage_and_bank(spark, tmp_path):
    df = spark.createDataFrame([("h", [1.0])], "hash string, vector array<float>")
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "part-0.parquet").write_bytes(b"half")  # what a failed write leaves
    assert tables.stage(df, f"{tmp_path}/s").count() == 1
    assert tables.stage(df.union(df), f"{tmp_path}/s", "2").count() == 2
    assert tables.load_bank(spark, f"{tmp_path}/b").count() == 0
    tables.save_bank(df, f"{tmp_path}/b")
    tables.save_bank(tables.load_bank(spark, f"{tmp_path}/b").union(df.withColumn("hash", F.lit("i"))), f"{tmp_path}/b")
    assert sorted(r.hash for r in tables.load_bank(spark, f"{tmp_path}/b").collect()) == ["h", "i"]
    (tmp_path / "b").rename(tmp_path / "b.old")
    assert tables.load_bank(spark, f"{tmp_path}/b").count() == 2
    spark.createDataFrame([(1, 2, "T1", 90.0, float("nan"))], "item_id_a long, item_id_b long, candidate_source string, candidate_score double, tfidf_cosine double").write.parquet(f"{tmp_path}/c")
    assert tuple(tables.read_candidates(spark, f"{tmp_path}/c").first()) == ("1", "2", "T1", 90.0, None, None, None, None)


def test_config():
    assert tables.read_config("# c\nexport KEY='a=b' # x\nmodel: text-embedding-3-large\n\nbatch=7", {"batch": "100"}) == {"KEY": "a=b", "model": "text-embedding-3-large", "batch": "7", "dim": "3072"}
    with pytest.raises(ValueError, match="unknown"):
        tables.read_config("model=x")


def test_context_of_two_records(spark):
    scored = spark.createDataFrame([("1", "Milk", "amy s kitchen", "1 oz", "Oat Milk", "amy s", "2 oz", 1), ("1", "Milk", "amy s kitchen", "1 oz", "Tea", "", "3 oz", 2), ("2", "Tea", "x", "", "Tea", "y", "", 1)], "item_id_a string, name_a string, brand_a string, size_a string, name_b string, brand_b string, size_b string, rank int")
    every = context.bootstrap(*(context.entries(spark.createDataFrame([(f"{kind}{i}", kind, f"{w} word") for i, w in enumerate(("milk", "tea", "A: Milk"))], "i string, k string, c string"), F.col("i"), kind, F.lit("T"), F.col("c"), F.lit(1.0)) for kind in ("rule", "accepted_example", "rejected_example")))
    indexed, bank = context.index(every, spark.createDataFrame([], "hash string, vector array<float>"))
    assert (indexed.count(), bank.count()) == (9, 3)
    targets = spark.createDataFrame([("dairy", "milk", 0.7, 20, 1), ("dairy", "eggs", 0.2, 20, 2)], "a_category string, b_category string, share double, support int, rank int")
    out = context.build(scored, indexed, targets, spark.createDataFrame([("1", "Dairy"), ("2", "none")], "item_id_a string, category string"))
    got = {r.item_id_a: r for r in out.select("*", context.prompt_block().alias("block"), context.context_signature().alias("sign")).collect()}
    assert [x.are_aliases for x in got["1"].aliases] == [True]
    assert got["1"].bridge_hint == "A category 'Dairy' typically maps to B categories: milk (share=0.70); eggs (share=0.20)"
    assert got["2"].bridge_hint is None
    assert "- B[0]: A.brand='x' vs B.brand='y' -> are_aliases=False" in got["2"].block.splitlines()
    assert len(got["1"].sign) == 16
    assert got["1"].sign != got["2"].sign
    assert all(len(r.rules or []) <= 3 and len(r.accepted or []) <= 2 for r in got.values())


def test_aliases_name_the_shorter_brand(spark):
    c = spark.createDataFrame([("clif", "clif bar", 100.0), ("good", "good foods", 99.0), ("a", "a b", 94.0), ("", "x", 100.0)], "a_brand string, b_brand string, score double")
    assert [(r.id, r.confidence) for r in context.alias_entries(c).collect()] == [("alias_clif_clif_bar", 1.0)]


def test_sure_targets(spark):
    wide = spark.createDataFrame([("a_cat2", "Milk ", 20, "Dairy", 0.8, "Eggs", 0.2, None, None), ("a_cat0", "Milk", 20, "Food", 1.0, None, None, None, None), ("a_cat3", "Tea", 5, "Tea", 1.0, None, None, None, None)], "a_level string, a_category string, support int, b_top1 string, b_top1_share double, b_top2 string, b_top2_share double, b_top3 string, b_top3_share double")
    told = lambda **how: sorted((r.a_category, r.b_category) for r in context.sure_targets(wide, **how).collect())
    assert told() == [("milk", "dairy"), ("milk", "eggs"), ("milk", "food")]
    assert told(share=0.5, levels=["a_cat2", "a_cat3"]) == [("milk", "dairy")]
    assert [r.id for r in context.bridge_entries(wide).collect()] == ["bridge_milk"]


def test_retrievers_give_candidates(spark):
    a, b = catalog.sides(spark, SF, *catalog_queries.SIDE)
    found = matching.union_candidates(*(r(a, b) for r in (context.sparse_texts(5), context.strict_blocks(), context.private_labels(catalog_queries.bridge(spark, SF)))))
    assert {"item_id_a", "item_id_b", "source", "score", "cosine"} <= set(found.columns)
    assert found.count() > 0


def test_context_bundle_and_benchmark(spark):
    rows = audit_queries.context_bundle(spark, SF).collect()
    assert rows and all("Relevant rules:" in r.block and len(r.signature) == 16 for r in rows)
    r = audit_queries.model_benchmark(spark, SF).first()
    assert r.valid_rate == 1.0
    assert r.n == r.tp + r.fp + r.fn + r.tn


def test_judgments_are_read_with_defaults(spark):
    raw = spark.createDataFrame([('{"is_match": true, "best_candidate_index": 3, "match_type": "exact", "confidence": 0.9}',), ("{}",), (None,)], "r string").select(knowledge.parse_judgment(F.col("r")).alias("j")).select("j.*").collect()
    assert [(r.json_valid, r.is_match, r.best_candidate_index, r.confidence) for r in raw] == [(True, True, 3, 0.9), (False, False, None, 0.0), (False, False, None, 0.0)]
