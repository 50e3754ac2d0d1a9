"""Helpers that several corpus operators use: tables in the shared folder, joins with hot keys, and Arrow batches."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_local: list[str] = []
_written: dict[str, object] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir. Where it is unset, a temporary one in a single process (tests); a cluster must name one."""
    conf = spark.sparkContext.getConf()
    found = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="matchspark-"))
    return f"file://{_local[0]}"


def _delete(path: str) -> None:
    session = _written.pop(path, None)
    if session is not None:
        at = session._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(session._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _clean() -> None:
    """Deletes what is left when the driver ends."""
    for path in list(_written):
        try:
            _delete(path)
        except Exception:  # the JVM may be gone already
            return


def materialize(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there and a lost executor loses nothing. The table goes with release() or when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/matchspark-{uuid.uuid4().hex}"
    _written[path] = spark
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._matchspark_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables of materialize() that nothing will read again."""
    for t in tables:
        _delete(t._matchspark_path)


def apart(df: DataFrame, key: str) -> DataFrame:
    """df dealt by another hash of the key, so that a join on the key gets an exchange of its own: only then can adaptive execution split a hot key's partition on the other side."""
    return df.repartition(F.xxhash64(F.lit("apart"), key))


def before(df: DataFrame, order: list[Column], sums: dict[str, Column], few: bool) -> DataFrame:
    """df with the sum over all rows that stand earlier in the order, for each name. Few rows are summed in one task; else ranges are sorted apart and one row a range meets in one task. The result is the same."""
    until = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    if few:
        return df.withColumns({k: F.coalesce(F.sum(v).over(until(W.orderBy(*order))), F.lit(0)) for k, v in sums.items()})
    dealt = materialize(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).withColumns({f"_of_{k}": v for k, v in sums.items()}))
    whole = dealt.groupBy(F.col("_range").alias("_at")).agg(*[F.sum(f"_of_{k}").alias(f"_whole_{k}") for k in sums])
    whole = whole.select("_at", *[F.coalesce(F.sum(f"_whole_{k}").over(until(W.orderBy("_at"))), F.lit(0)).alias(f"_before_{k}") for k in sums])
    out = dealt.join(F.broadcast(whole), F.col("_range") == F.col("_at"))  # a row a range
    inside = until(W.partitionBy("_range").orderBy(*order))
    return out.withColumns({k: F.col(f"_before_{k}") + F.coalesce(F.sum(f"_of_{k}").over(inside), F.lit(0)) for k in sums}).select(*df.columns, *sums)


def free(name: str, taken: Iterable[str]) -> str:
    """name, with as many underscores after it as keep it apart from the taken names (case doesn't tell names apart)."""
    lower = {x.lower() for x in taken}
    while name.lower() in lower:
        name += "_"
    return name


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case; other letters stay."""
    return F.translate(c, UPPER, LOWER)


def hex_sha256(c: Column) -> Column:
    return F.sha2(c, 256)


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The batch's texts, null as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def small_batches(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Cut batches, so that what is derived from one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
