"""Evaluation, profiling and sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.text import LEADING_DECIMAL, MULTIPACK, is_missing, shape
from .matching import top

BANDS = [(0.0, 0.5), (0.5, 0.7), (0.7, 0.85), (0.85, 0.95), (0.95, 1.01)]


def weighted_count(condition: Column, weight: str) -> Column:
    """How many rows meet a condition, where each stands for `weight` rows."""
    return F.coalesce(F.sum(F.when(condition, F.col(weight))), F.lit(0).cast("long"))


def weighted_rate(condition: Column, weight: str) -> Column:
    """The share of rows that meet a condition, of those where it isn't null; each stands for `weight` rows."""
    return F.try_divide(F.sum(F.when(condition, F.col(weight)).when(~condition, 0)).cast("double"), F.sum(F.when(condition.isNotNull(), F.col(weight))))


def confusion(df: DataFrame, truth: str, guess: str, by: list[str] | None = None) -> DataFrame:
    """n, tp, fp, fn, tn, precision, recall and f1 (of the rounded two); undefined ones are null."""
    t, g = F.col(truth), F.col(guess)
    cells = {"n": F.lit(True), "tp": t & g, "fp": ~t & g, "fn": t & ~g, "tn": ~t & ~g}
    out = df.groupBy(*(by or [])).agg(*[F.count_if(c).alias(k) for k, c in cells.items()])
    out = out.withColumns({"precision": F.bround(F.try_divide("tp", F.col("tp") + F.col("fp")), 4), "recall": F.bround(F.try_divide("tp", F.col("tp") + F.col("fn")), 4)})
    return out.withColumn("f1", F.bround(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), 4))


def calibration(df: DataFrame, confidence: str, right: str, bands=BANDS) -> DataFrame:
    """(low, high, n, accuracy) of half-open bands of confidence; empty ones are told too."""
    spark = df.sparkSession
    table = spark.createDataFrame([(float(a), float(b)) for a, b in bands], "low double, high double")
    c = F.col(confidence)
    counts = df.join(F.broadcast(table), (c >= F.col("low")) & (c < F.col("high"))).groupBy("low").agg(F.count("*").alias("k"), F.count_if(F.col(right)).alias("r"))
    return table.join(counts, "low", "left").select("low", "high", F.coalesce("k", F.lit(0)).alias("n"), F.bround(F.try_divide("r", "k"), 4).alias("accuracy"))


def quantiles(df: DataFrame, c: str, by: list[str], qs=(0.5, 0.9, 0.99)) -> DataFrame:
    return df.groupBy(*by).agg(*[F.round(F.percentile(c, q), 4).alias(f"p{round(100 * q)}") for q in qs])


def index_quantiles(df: DataFrame, c: str, by: list[str], qs=(0.9, 0.99)) -> DataFrame:
    """Values at place int(q * n) - 1 (from 0, at least 0) of each sorted group."""
    placed = df.where(F.col(c).isNotNull()).withColumns({"_i": F.row_number().over(W.partitionBy(*by).orderBy(c)), "_n": F.count("*").over(W.partitionBy(*by))})
    return placed.groupBy(*by).agg(*[F.max(F.when(F.col("_i") == F.greatest(F.floor(q * F.col("_n")), F.lit(1)), F.col(c))).alias(f"p{round(100 * q)}") for q in qs])


def column_summary(df: DataFrame, store: str) -> DataFrame:
    """(store, column, nonmissing, missing, missing_pct, distinct_nonmissing, example) of every column, in one pass."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    long = text.unpivot([], text.columns, "column", "value").withColumn("gone", is_missing(F.col("value")))
    out = long.groupBy("column").agg(F.count_if(~F.col("gone")).alias("nonmissing"), F.count_if("gone").alias("missing"), F.count_distinct(F.when(~F.col("gone"), F.col("value"))).alias("distinct_nonmissing"), F.min(F.when(~F.col("gone"), F.col("value"))).alias("example"))
    return out.select(F.lit(store).alias("store"), "column", "nonmissing", "missing", F.bround(100 * F.col("missing") / (F.col("missing") + F.col("nonmissing")), 4).alias("missing_pct"), "distinct_nonmissing", "example")


def top_values(df: DataFrame, columns: list[str], n: int = 25) -> DataFrame:
    """(field, value, count, share, rank): the n most frequent values of each column."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counts = text.unpivot([], columns, "field", "value").where(F.col("value").isNotNull()).groupBy("field", "value").agg(F.count("*").alias("count"))
    shares = counts.withColumn("share", F.bround(F.col("count") / F.sum("count").over(W.partitionBy("field")), 6))
    return top(shares, ["field"], [F.desc("count"), "value"], n)


def hash_order(key: str, seed: str) -> Column:
    return F.sha2(F.concat(F.lit(seed), F.col(key).cast("string")), 256)


def sample(df: DataFrame, key: str, n: int, seed: str = "42", by: list[str] | None = None) -> DataFrame:
    """n rows (of each group), the same ones at every run: those whose hashes are smallest."""
    if by:
        return top(df, by, [hash_order(key, seed)], n).drop("rank")
    return df.orderBy(hash_order(key, seed)).limit(n)


def metrics(df: DataFrame, truth: str, guess: str, undefined: float | None = None, by: list[str] | None = None, places: int = 4, weight: str | None = None) -> DataFrame:
    """n, tp, fp, fn, tn, precision, recall and f1, which is of the unrounded two; undefined: what an undefined one is (null by default); weight: a column that says how many rows each stands for."""
    t, g = F.col(truth), F.col(guess)
    cells = {"n": F.lit(True), "tp": t & g, "fp": ~t & g, "fn": t & ~g, "tn": ~t & ~g}
    out = df.groupBy(*(by or [])).agg(*[(weighted_count(c, weight) if weight else F.count_if(c)).alias(k) for k, c in cells.items()])
    p, r = F.try_divide("tp", F.col("tp") + F.col("fp")), F.try_divide("tp", F.col("tp") + F.col("fn"))
    told = lambda c: F.coalesce(F.bround(c, places), F.lit(undefined)) if undefined is not None else F.bround(c, places)
    f1 = F.when((p > 0) & (r > 0), 2 * p * r / (p + r))
    return out.withColumns({"precision": told(p), "recall": told(r), "f1": told(f1)})


def benchmark_report(df: DataFrame, prompt_price: float, completion_price: float, weight: str | None = None) -> DataFrame:
    """One row on a judge's answers (json_valid, truth, guess, truth_type, guess_type, prompt_tokens, completion_tokens): accuracies and precision, recall and f1 over the valid ones, 0 where undefined, and tokens and their cost (prices a million) over all. weight: a column that says how many answers a row stands for."""
    df = df.withColumn("_weight", F.col(weight) if weight else F.lit(1).cast("long"))
    valid = df.where("json_valid")
    rate = lambda c: F.bround(weighted_rate(c, "_weight"), 4)
    right = valid.agg(rate(F.col("truth") == F.col("guess")).alias("match_accuracy"), rate(F.col("truth_type") == F.col("guess_type")).alias("type_accuracy"))
    cost = F.col("prompt") / 1_000_000 * prompt_price + F.col("completion") / 1_000_000 * completion_price
    tokens = [F.sum(F.col(f"{c}_tokens") * F.col("_weight")).alias(c) for c in ("prompt", "completion")]
    whole = df.agg(rate(F.col("json_valid")).alias("valid_rate"), *tokens).withColumn("cost", F.round(cost, 6))
    return whole.join(F.broadcast(right)).join(F.broadcast(metrics(valid, "truth", "guess", 0.0, weight="_weight")))  # one row each


def top_shared(a: DataFrame, b: DataFrame, key: str, n: int = 100) -> DataFrame:
    """(key, count_a, count_b) of the n keys that both sides hold most often in all, ties by key."""
    left, right = (d.where(F.col(key) != "").groupBy(key).agg(F.count("*").alias(f"count_{s}")) for d, s in ((a, "a"), (b, "b")))
    return left.join(right, key).orderBy(F.desc(F.col("count_a") + F.col("count_b")), key).limit(n)


def parser_audit(df: DataFrame, by: str = "store_id") -> DataFrame:
    """Counts a store of what size parsers stumble on, from (name, size_source, size_bucket)."""
    c = F.col
    packed, dim = shape(c("name"), MULTIPACK), F.substring_index("size_bucket", ":", 1)
    leading, none = shape(c("size_source"), LEADING_DECIMAL), c("size_bucket") == ""
    return df.groupBy(by).agg(
        F.count("*").alias("rows"), F.count_if(packed).alias("multipack_in_name"), F.count_if(shape(c("size_source"), MULTIPACK)).alias("multipack_in_source"), F.count_if(leading).alias("leading_decimal"),
        F.count_if(c("size_bucket") == "count:1").alias("trivial_count"), F.count_if(packed & dim.isin("weight", "volume")).alias("multipack_unaccounted"), F.count_if(leading & none).alias("leading_decimal_unparsed"), F.count_if(none).alias("bucket_empty"),
    )


def parser_failures(df: DataFrame, order: str, k: int = 15) -> DataFrame:
    """The first k rows (store_id, ..., issue, rank) of each store and kind of failure."""
    c = F.col
    packed, dim = shape(c("name"), MULTIPACK), F.substring_index("size_bucket", ":", 1)
    issues = {"multipack_unaccounted": packed & dim.isin("weight", "volume"), "leading_decimal_unparsed": shape(c("size_source"), LEADING_DECIMAL) & (c("size_bucket") == ""), "trivial_count": c("size_bucket") == "count:1"}
    each = df.withColumn("issue", F.explode(F.array_compact(F.array(*[F.when(x, F.lit(k_)) for k_, x in issues.items()]))))
    return top(each, ["store_id", "issue"], [order], k)


def parser_deltas(df: DataFrame, by: str = "store_id") -> DataFrame:
    """Counts a store of what the parser's successor changes, from (size_bucket, unit_bucket, total_bucket, pack_count)."""
    old, unit, total = F.col("size_bucket"), F.col("unit_bucket"), F.col("total_bucket")
    return df.groupBy(by).agg(
        F.count("*").alias("rows"), F.count_if(old != "").alias("old_nonempty"), F.count_if(unit != "").alias("unit_nonempty"), F.count_if(total != "").alias("total_nonempty"), F.count_if((old == "") & (unit != "")).alias("recovered"),
        F.count_if((old == "count:1") & (unit == "")).alias("count1_removed"), F.count_if((F.col("pack_count") > 1) & (unit != "")).alias("multipack_with_unit"), F.count_if((old != unit) & (unit != "")).alias("changed"),
    )


def signal_stats(df: DataFrame, column: str, signals: dict[str, str]) -> DataFrame:
    """One row: rows, texts that are there and their rate, how many match each signal's pattern, and quantiles of length."""
    c = F.col(column)
    return df.agg(F.count("*").alias("rows"), F.count(c).alias("nonmissing"), F.bround(F.count(c) / F.count("*"), 4).alias("coverage"), *[F.count_if(c.rlike(x)).alias(k) for k, x in signals.items()], *[F.floor(F.percentile(F.length(c), q)).alias(f"len_p{round(100 * q)}") for q in (0.5, 0.9, 0.99)])


def field_coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """(field, coverage): the rate of rows where a column isn't missing."""
    rates = df.agg(*[F.bround(F.avg((~is_missing(F.col(c))).cast("int")), 4).alias(c) for c in columns])
    return rates.unpivot([], columns, "field", "coverage")


def extra_tokens(df: DataFrame, more: Column, than: Column) -> DataFrame:
    """One row on how many tokens `more` has beyond `than`: rows, mean, p50, p90 and rows with any."""
    n = df.select(F.size(F.array_except(more, than)).alias("n"))
    return n.agg(F.count("*").alias("rows"), F.bround(F.avg("n"), 3).alias("mean_extra"), F.bround(F.percentile("n", 0.5), 3).alias("p50_extra"), F.bround(F.percentile("n", 0.9), 3).alias("p90_extra"), F.count_if(F.col("n") > 0).alias("rows_with_extra"))


def stratified(df: DataFrame, key: str, strata: dict[str, tuple[Column, int]], seed: str = "42") -> DataFrame:
    """Up to n rows of each stratum (its condition, n), marked in `stratum`: those whose hashes are smallest. A row may stand in several."""
    listed = F.array_compact(F.array(*[F.when(cond, F.struct(F.lit(name).alias("stratum"), F.lit(n).alias("n"))) for name, (cond, n) in strata.items()]))
    each = df.withColumn("_s", F.explode(listed)).select("*", "_s.stratum", F.col("_s.n").alias("_n")).drop("_s")
    return top(each, ["stratum"], [hash_order(key, seed)], max(n for _, n in strata.values())).where("rank <= _n").drop("rank", "_n")


def surrogate_keys(df: DataFrame, order: list[str], name: str = "pair_id", prefix: str = "P") -> DataFrame:
    """df with keys P0000, P0001, ... in order. Meant for samples: one task numbers them."""
    return df.withColumn(name, F.concat(F.lit(prefix), F.lpad((F.row_number().over(W.orderBy(*order)) - 1).cast("string"), 4, "0")))


def totals(df: DataFrame, by: str) -> DataFrame:
    """(by, n) of each value, and of all under `total`."""
    return df.rollup(by).agg(F.count("*").alias("n"), F.grouping(by).alias("_all")).select(F.when(F.col("_all") == 1, "total").otherwise(F.col(by)).alias(by), "n")
