"""Copies of records cost no more pairs of classes, and what is made of classes equals what all pairs give."""

import random

import numpy as np
from pyspark.sql import functions as F

from matchspark.functions import text
from matchspark.operators import analysis, context, knowledge, matching, similarity


def sides(spark, copies, seed=3):
    r = random.Random(seed)
    kinds = [(r.choice(["x", "y", ""]), r.choice(["w:1", "w:2", ""]), r.choice(["w:1", "w:3", "w:2"]), r.choice(["red nut", "red bolt", "old nut"])) for _ in range(12)]
    rows = {s: [(f"{s}{i}-{c}", *k) for i, k in enumerate(kinds[o:] + kinds[:o]) for c in range(copies)] for s, o in (("a", 0), ("b", 5))}
    return rows, [spark.createDataFrame(v, f"item_id_{s} string, brand_{s} string, unit_bucket_{s} string, total_bucket_{s} string, name_norm_{s} string") for s, v in rows.items()]


def brute(rows):
    return [(a, b) for a in rows["a"] for b in rows["b"] if a[1] and a[1] == b[1] and ({*a[2:4]} & {*b[2:4]}) - {""}]


def test_copies_add_no_pairs_of_classes(spark):
    found = []
    for copies in (1, 4):
        rows, (a, b) = sides(spark, copies)
        p = matching.block_products(a, b).agg(F.count("*").alias("n"), F.sum("pairs").alias("pairs")).first()
        assert p.pairs == len(brute(rows))
        found.append(p.n)
    assert found[0] == found[1]


def test_block_pairs_are_made_without_shuffling_them(spark, monkeypatch):
    monkeypatch.setattr(matching, "CHUNK", 3)
    rows, (a, b) = sides(spark, 4)
    got = matching.strict_block_pairs(a, b)
    assert sorted(map(tuple, got.collect())) == sorted((x[0], y[0]) for x, y in brute(rows))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode(ids_b" in plan[: plan.index("Exchange")]


def test_firsts_of_blocks_equal_all_pairs(spark):
    rows, (a, b) = sides(spark, 4)
    by = ["name_norm", *matching.BLOCKED]
    alike = F.bround(text.jaccard(text.tokens(F.col("name_norm_a")), text.tokens(F.col("name_norm_b"))), 6)
    best = matching.block_firsts(a, b, 5, by, lambda p: p.withColumn("score", alike), [F.desc("score")])
    got = {(r.item_id_a, r["rank"]): r.item_id_b for r in matching.classed(a, "a", by).join(best, "class_a").collect()}
    want, jac = {}, lambda x, y: len({*x.split()} & {*y.split()}) / len({*x.split()} | {*y.split()})
    for i in {x[0] for x, _ in brute(rows)}:
        ranked = sorted((-round(jac(x[4], y[4]), 6), y[0]) for x, y in brute(rows) if x[0] == i)
        want |= {(i, n + 1): y for n, (_, y) in enumerate(ranked[:5])}
    assert got == want


def test_weighted_report_equals_rows(spark):
    rows = [(True, True, i % 2 == 0, "x", "x" if i % 3 else "y", 7 + i, 4, 1 + i % 3) for i in range(6)]
    df = spark.createDataFrame(rows, "json_valid boolean, truth boolean, guess boolean, truth_type string, guess_type string, prompt_tokens int, completion_tokens int, w long")
    many = df.select("*", F.explode(F.sequence(F.lit(1), F.col("w"))).alias("i"))
    assert analysis.benchmark_report(df, 0.25, 2.0, "w").collect() == analysis.benchmark_report(many, 0.25, 2.0).collect()


def test_narrowed_pools_come_without_pairs(spark):
    from matchspark.plans import catalog_queries

    plan = catalog_queries.narrowed_block(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    assert plan.count("Join") == 2


def test_dense_search_in_tiles_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(similarity, "TILE", (3, 7))
    v = np.random.default_rng(2).integers(-2, 3, size=(60, 3)).astype(float) + 0.5  # many ties
    df = spark.createDataFrame([(i, x.tolist(), str(i % 4)) for i, x in enumerate(v)], "id long, vector array<double>, kind string")
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    score = (u @ u.T).round(6)
    for same in (None, "kind"):
        got = {(r.id_a, r["rank"]): r.id_b for r in similarity.dense_topk(df.where("id < 8"), df, 4, 0.1, same=same).collect()}
        fit = lambda i: [j for j in np.argsort(-score[i], kind="stable") if score[i, j] >= 0.1 and (not same or (i - j) % 4 == 0)][:4]
        assert got == {(i, n + 1): j for i in range(8) for n, j in enumerate(fit(i))}


def test_scores_are_held_a_tile_at_a_time(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)
    was = similarity.nearest

    def nearest(q, v, *rest):
        seen.add(int(len(q) > 3 or len(v) > 7))
        return was(q, v, *rest)

    monkeypatch.setattr(similarity, "TILE", (3, 7))
    monkeypatch.setattr(similarity, "nearest", nearest)
    df = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(50)], "id long, vector array<double>")
    assert similarity.dense_topk(df, df, 2).count() == 100
    assert seen.value == 0


def test_equal_query_texts_are_searched_once(spark, monkeypatch):
    asked, was = [], similarity.dense_topk
    monkeypatch.setattr(similarity, "dense_topk", lambda queries, *rest: (asked.append(queries.count()), was(queries, *rest))[1])
    rows = spark.createDataFrame([(str(i), "nut", "x", "1 oz", "bolt", "x", "1 oz", 1) for i in range(5)], "item_id_a string, name_a string, brand_a string, size_a string, name_b string, brand_b string, size_b string, rank int")
    entries = spark.createDataFrame([("r1", "rule", "Rule", "nut bolt")], "id string, type string, title string, content string")
    indexed = entries.join(knowledge.embed(entries.select(F.col("id").alias("hash"), F.col("content").alias("text"))).withColumnRenamed("hash", "id"), "id")
    targets = spark.createDataFrame([], "a_category string, b_category string, share double, support long, rank int")
    built = context.build(rows, indexed, targets, spark.createDataFrame([], "item_id_a string, category string")).collect()
    assert asked == [1, 1, 1]
    assert len(built) == 5
    assert all([x.id for x in r.rules] == ["r1"] for r in built)


def test_near_best_hold_the_best_and_score_few_pairs(spark):
    from matchspark.plans import catalog_queries as q

    r = random.Random(5)
    kinds = [(" ".join(r.choices(["red", "old", "nut", "bolt", "vanilla", "lemon", "organic"], k=2)), r.choice(["dairy", "metal", "metal food"]), r.choice([8.0, 8.5])) for _ in range(80)]
    columns = [*q.ALIKE, "food_like"]

    def side(s, rows):
        made = [(f"{s}{i}", n, "x", "x", c, False, "weight", v, v, 1, "w:8", "w:8", c != "metal") for i, (n, c, v) in enumerate(rows)]
        kind = {"is_private_label": "boolean", "unit_value": "double", "total_value": "double", "pack_count": "int", "food_like": "boolean"}
        return spark.createDataFrame(made, f"item_id_{s} string, " + ", ".join(f"{c}_{s} {kind.get(c, 'string')}" for c in columns))

    a, b = side("a", kinds[:30]), side("b", kinds)
    score = lambda p: matching.features(q.unscored(p)).select("class_a", "class_b", "firsts", F.round("final_score", 3).alias("final_score"))
    for k in (1, 5):
        every = matching.block_firsts(a, b, k, columns, score, [F.desc("final_score")])
        few = matching.block_firsts(a, b, k, columns, score, [F.desc("final_score")], list(q.CORE), q.bounded)
        told = lambda d: sorted((str(x.class_a), x["rank"], x.item_id_b, x.final_score) for x in d.collect())
        assert told(few) == told(every)
    pairs = matching.block_join(*(matching.classed(d, s, columns).select(f"class_{s}").distinct() for d, s in ((a, "a"), (b, "b"))))
    assert matching.near_best(a, b, 1, columns, list(q.CORE), q.bounded).count() < pairs.count() / 4


def test_routes_need_no_categories(spark):
    from matchspark.plans import catalog_queries as q

    sf = "/root/testdata/sf0.01"
    one, two = q.products(spark, sf), q.routes(spark, sf)
    by = ["route", "brand_relation", "unit_relation", "name_jaccard"]
    told = lambda d: sorted(map(tuple, d.groupBy(*by).agg(F.sum("pairs")).collect()))
    assert told(one) == told(two)
    assert "category_norm_a" not in two.schema["class_a"].dataType.names
    assert two.count() <= one.count()


def test_bridge_parses_sizes_once_a_form(spark):
    from matchspark.plans import audit_queries, catalog_queries

    for q in (catalog_queries.category_bridge, audit_queries.bridge_entries, audit_queries.bridge_hints):
        plan = q(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "regexp" in plan
        lines = plan.splitlines()
        scan = next(i for i, x in enumerate(lines) if "Relation" in x)
        forms = max(i for i, x in enumerate(lines[:scan]) if "Aggregate" in x)
        assert not any("regexp" in x for x in lines[forms:scan])


def test_bridge_counts_rows_without_sorting_them(spark):
    from matchspark.plans import audit_queries, catalog_queries

    for q in (audit_queries.bridge_entries, audit_queries.bridge_hints, catalog_queries.category_bridge):
        lines = q(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString().splitlines()
        for scan in (i for i, x in enumerate(lines) if "FileScan" in x):
            first = max(i for i, x in enumerate(lines[:scan]) if "Exchange" in x)
            assert any("HashAggregate" in x for x in lines[first:scan])
            assert not any("Sort" in x for x in lines[first:scan])


def test_kinds_find_first_ids_without_sorting_rows(spark, tmp_path):
    from matchspark.operators import catalog

    r = random.Random(3)
    keys = [*r.sample(range(-1200, 12000), 600), *range(-12, 12), None]
    rows = [(k, "nut", f"Brand#{r.randrange(3)}", r.choice(["LARGE", "SMALL"]), r.randrange(1, 3), 1.0) for k in dict.fromkeys(keys)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    columns = ("brand_raw", "info_category_0", "size_text")
    both = zip(catalog.kinds(spark, str(tmp_path), *columns, ids=True), catalog.sides(spark, str(tmp_path), *columns), strict=True)
    for s, (few, every) in zip("ab", both, strict=True):
        by = [f"{c}_{s}" for c in columns]
        want = every.groupBy(*by).agg(F.min(f"item_id_{s}").alias("first"), F.count("*").alias("n"))
        got = few.select(*by, f"item_id_{s}", f"n_{s}")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.toDF(*got.columns).collect()))
        lines = few._jdf.queryExecution().executedPlan().toString().splitlines()
        scan = next(i for i, x in enumerate(lines) if "FileScan" in x)
        assert not any("Sort" in x for x in lines[max(i for i, x in enumerate(lines[:scan]) if "Exchange" in x) : scan])
    assert not any("item_id" in c for d in catalog.kinds(spark, str(tmp_path), *columns) for c in d.columns)


def test_shares_are_printed_as_sql_prints_them(spark):
    shares = [0.175, 0.125, 0.375, 0.285, 0.29, 0.5, 0.1749, 0.0, 1.0, 0.005, 0.015, *[i / 1000 for i in range(0, 1000, 7)], *[(2 * i + 1) / 200 for i in range(100)]]
    got = [r.t for r in spark.createDataFrame([(x,) for x in shares], "x double").select(text.two_places(F.col("x")).alias("t")).collect()]
    assert got == [f"{x:.2f}" for x in shares]


def tiled_sides(spark, copies):
    """Two sides of tiles by the raw columns that brute() reads, of three records at most."""
    rows, both = sides(spark, copies)
    raw = [d.toDF("item_id", "brand", "unit_bucket", "total_bucket", "name").where("name != ''") for d in both]
    more = {"brand_norm": "brand", "is_private_label": "false", "dim": "unit_bucket", "unit_value": "1D", "total_value": "1D", "pack_count": "1"}
    made = [matching.tiles(d, ["brand", "unit_bucket", "total_bucket"], ("name", {"words": lambda c: text.tokens(c)})).withColumns({k: F.expr(v) for k, v in more.items()}) for d in raw]
    return rows, [d.toDF(*[f"{c}_{s}" for c in d.columns]) for d, s in zip(made, "ab", strict=True)]


def test_pairs_of_tiles_equal_all_pairs_and_shuffle_none(spark, monkeypatch):
    monkeypatch.setattr(matching, "TILE", 3)
    rows, (a, b) = tiled_sides(spark, 4)
    tiles = a.select(F.aggregate("items_a", F.lit(0), lambda n, x: n + F.size(x["items"])).alias("n")).collect()
    assert max(x.n for x in tiles) == 3
    got = matching.opened(matching.opened(matching.tile_pairs(a, b)))
    assert sorted((x.item_id_a, x.item_id_b) for x in got.collect()) == sorted((x[0], y[0]) for x, y in brute(rows))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan[: plan.index("Exchange")].count("Generate explode") == 4


def test_all_pair_queries_parse_once_a_tile_and_shuffle_no_pairs(spark):
    from matchspark.plans import catalog_queries as q

    for f, levels in ((q.strict_block_pairs, 1), (q.size_relation, 1), (q.score_route, 3)):
        df = f(spark, "/root/testdata/sf0.001")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan[: plan.index("Exchange")].count("Generate explode") == 2 * levels
        lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        scan = next(i for i, x in enumerate(lines) if "Relation" in x)
        assert not any("regexp" in x for x in lines[max(i for i, x in enumerate(lines[:scan]) if "Window" in x) : scan])
