"""Sources and sinks: typed CSV and JSONL scans, stage tables, key-value banks, reports."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

RAW = "item_id name brand_raw name_clean description category department url item_type is_organic item_info tags subcategory is_private_label sizing_comp size_raw datapoint_id raw_data_id created_at_utc updated_at_utc".split()
KNOWLEDGE = "id string, type string, title string, content string, match_type string, product_domain string, requires_brand_relation string, requires_size_relation string, store_scope string, tags array<string>, source string, confidence double, embedding_text string"
JUDGMENT = "cache_key string, a_id string, b_ids array<string>, best_candidate_index int, is_match boolean, match_type string, confidence double, reason_codes array<string>, tools_used array<string>, evidence_summary string, latency_s double, json_valid boolean, prompt_tokens int, completion_tokens int, raw_response string, error string"


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """All columns as text; quoted line breaks and doubled quotes are read."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns or RAW])
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').option("enforceSchema", False).csv(path)


def write_csv(df: DataFrame, path: str, rename: dict[str, str] | None = None) -> None:
    for a, b in (rename or {}).items():
        df = df.withColumnRenamed(a, b)
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_jsonl(spark: SparkSession, path: str, schema: str = KNOWLEDGE) -> DataFrame:
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def stage(df: DataFrame, path: str, version: str | None = None) -> DataFrame:
    """A stage's table: written once, read where it is there whole (a folder that a failed write left is written again). version, such as a hash of what it depends on, keeps tables apart."""
    spark, path = df.sparkSession, f"{path}/v={version}" if version else path
    done, files = _folder(spark, f"{path}/_SUCCESS")
    if not files.exists(done):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def save_bank(bank: DataFrame, path: str) -> None:
    """Write a key-value bank to a new folder beside path and put it in its place, so readers see the old one or the new one."""
    spark = bank.sparkSession
    bank.write.mode("overwrite").parquet(f"{path}.new")
    (at, files), (new, _), (old, _) = _folder(spark, path), _folder(spark, f"{path}.new"), _folder(spark, f"{path}.old")
    files.delete(old, True)
    if files.exists(at):
        files.rename(at, old)
    files.rename(new, at)
    files.delete(old, True)


def load_bank(spark: SparkSession, path: str, schema: str = "hash string, vector array<float>") -> DataFrame:
    """A bank of save_bank(), empty where there is none; after a stop between the two renames the old one is read."""
    for found in (path, f"{path}.old"):
        at, files = _folder(spark, found)
        if files.exists(at):
            return spark.read.schema(schema).parquet(found)
    return spark.createDataFrame([], schema)


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """Candidates of an earlier run: ids as text, source and score, and the four features that are kept, null where they lack."""
    rows = spark.read.parquet(path)
    kept = {"rapidfuzz_wratio_name": "double", "tfidf_cosine": "double", "block_brand": "string", "private_label_both": "boolean"}
    cols = [F.col(c).cast(t).alias(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in kept.items()]
    clean = [F.when(~F.isnan(c), c).alias(n) if t == "double" else c.alias(n) for c, (n, t) in zip(cols, kept.items(), strict=True)]
    return rows.select(F.col("item_id_a").cast("string").alias("item_id_a"), F.col("item_id_b").cast("string").alias("item_id_b"), F.col("candidate_source").alias("source"), F.col("candidate_score").cast("double").alias("score"), *clean)


#: How long a model's vectors are.
DIMENSIONS = {"text-embedding-3-small": 1536, "text-embedding-3-large": 3072, "text-embedding-ada-002": 1536}


def read_config(text: str, defaults: dict[str, str] | None = None) -> dict[str, str]:
    """Settings of KEY=value or `key: value` lines (comments, quotes and `export` are read past); a known embedding model adds its dim, an unknown one fails."""
    found = dict(defaults or {})
    for line in text.splitlines():
        line = line.strip().removeprefix("export ")
        cut = min((i for i in (line.find("="), line.find(":")) if i > 0), default=0)
        if cut and not line.startswith("#"):
            found[line[:cut].strip()] = line[cut + 1 :].split(" #")[0].strip().strip("'\"")
    model = found.get("model")
    if model is not None:
        if model not in DIMENSIONS and "dim" not in found:
            raise ValueError(f"unknown embedding model {model!r}")
        found.setdefault("dim", str(DIMENSIONS.get(model)))
    return found


def misses(wanted: DataFrame, bank: DataFrame, key: str) -> DataFrame:
    """Rows whose key the bank doesn't hold."""
    return wanted.join(bank.select(key).distinct(), key, "left_anti")


def latest(log: DataFrame, key: str, order: str) -> DataFrame:
    """The last entry of each key in an append-only log; lines without a key are skipped."""
    return log.where(F.col(key).isNotNull()).withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(F.desc(order)))).where("_n = 1").drop("_n")


def report(metrics: DataFrame, title: str) -> tuple[str, str]:
    """A few rows of metrics as Markdown and JSON text."""
    rows = [r.asDict() for r in metrics.collect()]
    lines = [f"# {title}", "", "| " + " | ".join(metrics.columns) + " |", "|" + "---|" * len(metrics.columns)]
    return "\n".join(lines + ["| " + " | ".join(str(v) for v in r.values()) + " |" for r in rows]), json.dumps(rows, default=str)
