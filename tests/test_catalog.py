"""Catalog queries against DuckDB on the smallest tables, and properties of the scalar operators."""

import decimal

import duckdb
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from matchspark.functions import fuzzy, size, text
from matchspark.operators import analysis, catalog, knowledge, matching, similarity
from matchspark.plans import catalog_queries
from matchspark.sources import tables
from matchspark.streaming.incremental import match_stream

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    if isinstance(v, bool) or v is None:
        return str(v)
    return repr(round(float(v), 9)) if isinstance(v, (int, float)) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog_queries.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = catalog_queries.queries()[name](spark, SF)
    names = sorted(got.columns)
    want = duck.sql(catalog_queries.oracle_sql()[name])
    assert names == sorted(want.columns)
    place = [want.columns.index(c) for c in names]
    assert sorted(tuple(map(plain, r)) for r in got.select(*names).collect()) == sorted(tuple(plain(r[i]) for i in place) for r in want.fetchall())


def test_match_catalogs_gives_one_partner(spark):
    rows = catalog_queries.queries()["match_catalogs"](spark, SF).collect()
    assert rows and len({r.item_id_a for r in rows}) == len(rows)


def test_candidates_have_the_text_join_with_cosines(spark):
    c = {(r.item_id_a, r.item_id_b): r for r in catalog_queries.candidates(spark, SF).collect()}
    blocks = {(r.item_id_a, r.item_id_b) for r in catalog_queries.candidate_union(spark, SF).collect()}
    assert blocks < set(c)
    assert all(("T3" in r.source) == (r.cosine is not None) for r in c.values())
    assert any(r.source == "T3" and r.cosine >= 0.4 for r in c.values())


@pytest.mark.parametrize(("given_", "dim", "unit", "total", "packs"), [("12 fl oz", "volume", 12, 12, 1), ("12 x 12 fl oz", "volume", 12, 144, 12), ("4 pk 8.5 oz", "weight", 8.5, 34, 4), ("50 ct", "count", 50, 50, 50), (".5 L", "volume", 16.907, 16.907, 1), ("4 pk 3 lb", "weight", 48, 192, 4)])
def test_sizes(spark, given_, dim, unit, total, packs):
    s = spark.createDataFrame([(given_,)], "t string").select(size.parse_size(F.col("t")).alias("s")).first().s
    assert (s.dim, s.unit_value, s.total_value, s.pack_count) == (dim, unit, total, packs)


def test_size_edges(spark):
    rows = spark.createDataFrame([("",), (None,), ("nan",), ("1 ct",)], "t string").select(size.parse_size(F.col("t")).alias("s")).collect()
    assert [r.s.unit_bucket if r.s else None for r in rows] in ([None, None, None, ""], ["", "", "", ""])


@given(st.text("ab cd", max_size=12), st.text("ab cd", max_size=12))
def test_ratio_is_symmetric_and_bounded(a, b):
    x = fuzzy.weighted_ratio(a, b)
    assert 0 <= x <= 100
    assert abs(x - fuzzy.weighted_ratio(b, a)) < 1e-9


def test_similar_names_equal_all_pairs(spark):
    r = __import__("random").Random(4)
    a = ["kellogg", "general mills", "amy s kitchen", "ab", "clif bar company", "stonyfield organic farms", *("".join(r.choices("abcd", k=r.randint(5, 12))) for _ in range(60))]
    b = ["kelloggs", "generalmills", "amys kitchen", "ab c", "clifbar compan", "zz", *(x[:i] + x[i + 1 :] for x in a for i in (r.randrange(len(x)),))]
    got = {tuple(x) for x in matching.similar_names(*(spark.createDataFrame([(x,) for x in sorted(set(v))], f"{n} string") for v, n in ((b, "b_brand"), (a, "a_brand")))).collect()}
    best = {x: max(((round(fuzzy.token_set_ratio(x, y), 6), y) for y in sorted(set(a))), key=lambda v: v[0]) for x in set(b)}
    assert got == {(x, y, s) for x, (s, y) in best.items() if s >= 90}
    assert ("kelloggs", "kellogg") in {x[:2] for x in got}


def test_alias_join_is_of_unshared_brands(spark, tmp_path):
    spark.read.parquet(f"{SF}/part.parquet").withColumns({"p_brand": F.expr("if(p_partkey div 2 % 2 = 0, 'acme foods', 'acme food')"), "p_type": F.lit("SMALL")}).write.parquet(f"{tmp_path}/part.parquet")
    assert catalog_queries.queries()["alias_fuzzy_join"](spark, str(tmp_path)).count() == 0
    brands = {s: {r[0] for r in catalog.parts(spark, SF).where(F.col("store_id") == s).select(F.concat_ws(" ", "brand_norm", "category_norm")).collect()} for s in "AB"}
    got = {(r.b_brand, r.score) for r in catalog_queries.queries()["alias_fuzzy_join"](spark, SF).collect()}
    best = {x: max(round(fuzzy.token_set_ratio(x, y), 6) for y in brands["A"]) for x in brands["B"] - brands["A"]}
    assert got == {(x, s) for x, s in best.items() if s >= 90}


@given(st.text("abc", max_size=10), st.text("abc", max_size=10))
def test_common_subsequence(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    assert fuzzy.common(a, b) == t[-1][-1]


def test_known_ratios():
    assert fuzzy.weighted_ratio("great value milk", "great value milk") == 100
    assert fuzzy.weighted_ratio("", "x") == 0
    assert abs(fuzzy.weighted_ratio("cheddar cheese", "sharp cheddar cheese block family size") - 90) < 1e-9  # a whole substring
    assert abs(fuzzy.weighted_ratio("cheddar milk", "sharp cheddar cheese block family size") - 85.5) < 1e-9  # one shared word


def test_text_edges(spark):
    r = spark.createDataFrame([("  NaN ", "A & B--C", "https://s.com/ip/Big-Bag/123/")], "a string, b string, u string").select(text.normalize(F.col("a")).alias("a"), text.normalize(F.col("b")).alias("b"), text.url_segments_slug(F.col("u")).alias("u")).first()
    assert tuple(r) == ("", "a and b c", "big-bag")


def test_union_is_commutative(spark):
    a = spark.createDataFrame([("1", "2", "T1", 1.0)], "item_id_a string, item_id_b string, source string, score double")
    b = spark.createDataFrame([("1", "2", "T3", 2.0), ("1", "3", "T3", 0.5)], a.schema)
    one, two = (sorted(map(tuple, matching.union_candidates(*x).collect())) for x in ((a, b), (b, a)))
    assert one == two == [("1", "2", "T1+T3", 2.0), ("1", "3", "T3", 0.5)]


def test_select_one_breaks_ties(spark):
    rows = spark.createDataFrame([("1", "b", 0.5, None, 1.0), ("1", "a", 0.5, None, 1.0), ("1", "c", 0.5, 0.1, 0.0), ("2", "z", 0.1, None, None)], "item_id_a string, item_id_b string, final_score double, confidence double, score double")
    once = matching.select_one(rows)
    assert sorted((r.item_id_a, r.item_id_b) for r in once.collect()) == [("1", "c"), ("2", "z")]
    assert sorted(map(tuple, matching.select_one(once).collect())) == sorted(map(tuple, once.collect()))


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([("1", 'a "quoted"\nname'), ("x|1", "b")], "item_id string, name string")
    tables.write_csv(df, f"{tmp_path}/c")
    assert sorted(map(tuple, tables.read_csv(spark, f"{tmp_path}/c", ["item_id", "name"]).collect()))[1] == ("x|1", "b")
    assert tables.stage(df, f"{tmp_path}/s").count() == tables.stage(df, f"{tmp_path}/s").count() == 2
    tables.write_jsonl(spark.createDataFrame([("k", "t")], "id string, type string"), f"{tmp_path}/j")
    assert tables.read_jsonl(spark, f"{tmp_path}/j").first().id == "k"
    log = spark.createDataFrame([("k", 1), ("k", 2), (None, 3)], "key string, at int")
    assert [r.at for r in tables.latest(log, "key", "at").collect()] == [2]
    assert "| item_id |" in tables.report(df.select("item_id"), "T")[0]
    kept = catalog.hygiene(df.withColumn("n", F.monotonically_increasing_id()), "item_id", "n", "A").collect()
    assert [r.item_id for r in kept] == ["1"]


def test_cached_embeddings_are_not_made_again(spark):
    rows = spark.createDataFrame([("1", "h1", "a b"), ("2", "h2", "c"), ("3", "h2", "c")], "id string, hash string, text string")
    bank = knowledge.embed(rows.where("hash = 'h1'").select("hash", "text"))
    asked = []

    def embedder(df):
        asked.append([r.hash for r in df.collect()])
        return knowledge.embed(df)

    done, grown = knowledge.embed_incrementally(rows, bank, embedder)
    assert asked == [["h2"]]
    assert done.count() == 3
    assert grown.count() == 2


def test_dense_search_equals_brute_force(spark):
    import numpy as np

    v = np.random.default_rng(1).normal(size=(40, 6))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, vector array<double>")
    got = {(r.id_a, r["rank"]): r.id_b for r in similarity.dense_topk(df.where("id < 5"), df, 3).collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    order = np.argsort(-(u[:5] @ u.T).round(6), axis=1, kind="stable")[:, :3]
    assert got == {(i, j + 1): order[i, j] for i in range(5) for j in range(3)}


def test_samples_repeat(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 3)
    assert analysis.sample(df, "id", 10).collect() == analysis.sample(df.repartition(7), "id", 10).collect()
    assert analysis.sample(df, "id", 4, by=["g"]).count() == 12


def test_stream_appends_each_batch_once(spark, tmp_path):
    df = spark.createDataFrame([("1", "A b")], "item_id string, name string")
    df.write.parquet(f"{tmp_path}/in")
    rows = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    for _ in range(2):
        match_stream(rows, lambda b: b.select("item_id", text.normalize(F.col("name")).alias("n")), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert [r.n for r in spark.read.parquet(f"{tmp_path}/out").collect()] == ["a b"]
