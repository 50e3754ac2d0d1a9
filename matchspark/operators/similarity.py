"""Sparse and dense similarity search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .matching import top

#: Queries a broadcast holds, and queries and rows that are compared at once.
BLOCK, TILE = 65_536, (256, 4096)


def word_grams(c: Column) -> Column:
    """Words of two or more characters and pairs of neighbours, prefixed w:."""
    w = F.regexp_extract_all(F.lower(c), F.lit(r"(\w\w+)"), F.lit(1))
    two = F.when(F.size(w) > 1, F.transform(F.slice(w, 1, F.size(w) - 1), lambda x, i: F.concat(x, F.lit(" "), F.get(w, i + 1)))).otherwise(F.array().cast("array<string>"))
    return F.transform(F.concat(w, two), lambda x: F.concat(F.lit("w:"), x))


def char_grams(c: Column, low: int = 3, high: int = 5) -> Column:
    """Character n-grams within words padded by a space, prefixed c:. A padded word no longer than n is one gram, and is not cut by longer n."""
    padded = F.transform(F.filter(F.split(F.lower(c), r"\s+"), lambda x: x != ""), lambda x: F.concat(F.lit(" "), x, F.lit(" ")))

    def of_length(w: Column, k: int) -> Column:
        n = F.length(w)
        cut = F.transform(F.sequence(F.lit(1), F.greatest(n - k + 1, F.lit(1))), lambda i: F.substr(w, i, F.lit(k)))
        whole = n <= k if k == low else n == k
        return F.when(n > k, cut).when(whole, F.array(w)).otherwise(F.array().cast("array<string>"))

    def of(w: Column) -> Column:
        return F.concat(*[of_length(w, k) for k in range(low, high + 1)])

    return F.transform(F.flatten(F.transform(padded, of)), lambda x: F.concat(F.lit("c:"), x))


def tfidf(docs: DataFrame, min_df: int = 2, max_share: float = 0.6, chars: bool = True) -> DataFrame:
    """(id, term, weight) from rows (id, text): (1 + ln tf) * (ln((1 + n) / (1 + df)) + 1), length 1 a document."""
    grams = F.concat(word_grams(F.col("text")), char_grams(F.col("text"))) if chars else word_grams(F.col("text"))
    tf = docs.select("id", F.explode(grams).alias("term")).groupBy("id", "term").agg(F.count("*").alias("tf"))
    n = docs.agg(F.count("*").alias("n"))
    df = tf.groupBy("term").agg(F.count("*").alias("df")).join(F.broadcast(n)).where((F.col("df") >= min_df) & (F.col("df") <= max_share * F.col("n")))
    w = tf.join(df, "term").select("id", "term", ((1 + F.log("tf")) * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1)).alias("w"))
    norm = w.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return w.join(norm, "id").select("id", "term", (F.col("w") / F.col("norm")).alias("weight"))


def sparse_topk(a: DataFrame, b: DataFrame, k: int = 20, floor: float = 0.4, **how) -> DataFrame:
    """(id_a, id_b, score, rank) of rows (id, text): the k most similar rows of B by TF-IDF cosine, at least `floor`.

    Weights and similarities are computed once for each distinct text (document counts are of rows), and of rows of B with
    one text only the first k ids can be among any record's best.
    """
    texts = a.select("text").union(b.select("text")).groupBy("text").agg(F.count("*").alias("copies"))
    weights = weighted_texts(texts, **how)
    left = weights.join(a.select("text").distinct(), "text", "left_semi")
    right = weights.join(b.select("text").distinct(), "text", "left_semi")
    dots = left.select(F.col("text").alias("text_a"), "term", F.col("weight").alias("wa")).join(right.select(F.col("text").alias("text_b"), "term", F.col("weight").alias("wb")), "term")
    near = dots.groupBy("text_a", "text_b").agg(F.round(F.sum(F.col("wa") * F.col("wb")), 6).alias("score")).where(F.col("score") >= floor)
    few = top(b.select(F.col("id").alias("id_b"), F.col("text").alias("text_b")), ["text_b"], ["id_b"], k).drop("rank")
    best = top(near.join(few, "text_b"), ["text_a"], [F.desc("score"), "id_b"], k).select("text_a", "id_b", "score", "rank")
    return a.select(F.col("id").alias("id_a"), F.col("text").alias("text_a")).join(best, "text_a").select("id_a", "id_b", "score", "rank")


def weighted_texts(texts: DataFrame, min_df: int = 2, max_share: float = 0.6, chars: bool = True, per_kind: bool = False) -> DataFrame:
    """tfidf() of distinct texts (text, copies), counting each as often as it stands. per_kind: words and characters have length 1 each before the text has."""
    grams = F.concat(word_grams(F.col("text")), char_grams(F.col("text"))) if chars else word_grams(F.col("text"))
    tf = texts.select("text", "copies", F.explode(grams).alias("term")).groupBy("text", "copies", "term").agg(F.count("*").alias("tf"))
    n = texts.agg(F.sum("copies").alias("n"))
    df = tf.groupBy("term").agg(F.sum("copies").alias("df")).join(F.broadcast(n)).where((F.col("df") >= min_df) & (F.col("df") <= max_share * F.col("n")))
    w = tf.join(df, "term").select("text", "term", ((1 + F.log("tf")) * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1)).alias("w"))
    if per_kind:
        kind = F.substring("term", 1, 1)
        each = w.groupBy("text", kind.alias("kind")).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("own"))
        w = w.withColumn("kind", kind).join(each, ["text", "kind"]).select("text", "term", (F.col("w") / F.col("own")).alias("w"))
    norm = w.groupBy("text").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return w.join(norm, "text").select("text", "term", (F.col("w") / F.col("norm")).alias("weight"))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def nearest(q: np.ndarray, v: np.ndarray, fit: np.ndarray | None, k: int, floor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places in q, places in v, scores): the k rows v of highest dot product with each q, at least `floor`, ties by place. fit: which may meet."""
    score = np.round(q @ v.T, 6)
    score[np.isnan(score) if fit is None else np.isnan(score) | ~fit] = -np.inf
    least = np.partition(score, -k, axis=1)[:, -k] if k < score.shape[1] else np.full(len(q), -np.inf)
    i, j = np.nonzero(score >= np.maximum(least, floor)[:, None])
    order = np.lexsort((j, -score[i, j], i))
    i, j = i[order], j[order]
    kept = np.arange(len(i)) - np.searchsorted(i, i) < k
    return i[kept], j[kept], score[i[kept], j[kept]]


def dense_topk(queries: DataFrame, rows: DataFrame, k: int = 20, floor: float = -1.0, same: str | None = None) -> DataFrame:
    """(id_a, id_b, score, rank) of (id, vector): the k rows nearest to each query by cosine, at least `floor`; same: a column both must share.

    Queries go to the executors in blocks of BLOCK vectors; rows are scanned once a block and never shuffled, and each task
    sends on at most k rows a query and batch. Scores are held for one TILE at a time, however many queries and rows there are.
    """
    spark = queries.sparkSession
    kinds = [queries.schema["id"].dataType.simpleString(), rows.schema["id"].dataType.simpleString()]
    out_schema = f"id_a {kinds[0]}, id_b {kinds[1]}, score double"
    blocks = max(1, -(-queries.count() // BLOCK))
    extra = [F.col(same).cast("string").alias("same")] if same else [F.lit("").alias("same")]
    numbered = queries.select("id", "vector", *extra)
    parts = []
    for n in range(blocks):
        block = (numbered.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == n) if blocks > 1 else numbered).collect()
        ids, tags = np.array([r.id for r in block], object), np.array([r.same for r in block], object)
        q = np.array([r.vector for r in block], np.float64).reshape(len(block), -1)
        sent = spark.sparkContext.broadcast((ids, tags, q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-300)))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, tags, q = sent.value
            wide, tall = TILE
            for whole in batches:
                for b in (whole.slice(at, tall) for at in range(0, whole.num_rows, tall) if len(ids)):
                    names, v, tag = np.array(b.column(0).to_pylist(), object), np.array(b.column(1).to_pylist(), np.float64), np.array(b.column(2).to_pylist(), object)
                    order = np.argsort(names, kind="stable")
                    names, tag, v = names[order], tag[order], v[order]
                    v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
                    for at in range(0, len(ids), wide):
                        fit = tags[at : at + wide, None] == tag[None, :] if same else None
                        i, j, score = nearest(q[at : at + wide], v, fit, k, floor)
                        if len(i):  # an empty batch has no types
                            yield pa.RecordBatch.from_pydict({"id_a": ids[at + i].tolist(), "id_b": names[j].tolist(), "score": score})

        parts.append(rows.select("id", "vector", *extra).mapInArrow(run, out_schema))
    every = parts[0]
    for p in parts[1:]:
        every = every.union(p)
    return top(every, ["id_a"], [F.desc("score"), "id_b"], k)
