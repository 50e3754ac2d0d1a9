"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected copies: the source's target over its size. Their prefix sums, shifted
by one random offset a source, cross integers; a document is emitted once for each integer that it crosses.

A source's documents stand by size level, then by the hash of their id and text, then by size, id and text. A level is a
sixteenth of an octave, so each run of likely sizes gives its share and the words taken come near the target. The order is
the same at every number of rows, and it is one of cells (source, level, 3 hexadecimal digits of the hash): each cell is
ranked on its own, and its ranks are shifted by the counts of the cells before. No task sorts a source, and reruns agree.

Null texts have size 0. Null sources are one source. Empty documents are sampled like others and take no words. Null ids
are one id. Rows that share an id are sampled on their own; those that share the text too are told apart by their other
columns, and equal rows are alike, whichever of them is taken. A table without rows gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ._shared import WORD, before, free, materialize

WEIGHTS, SHARE, MOST, SEED = (3, 1, 2), 1.5, 2, "mix"
FEW = 10_000  # sources whose targets one task may reckon; more are dealt in ranges, with the same result
CELL = ["_named", "_level", "_salt"]


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def level(size: Column) -> Column:
    """Rises with size: the number of its binary digits, then the first five of them."""
    return F.concat(F.lpad(F.length(F.bin(size)).cast("string"), 2, "0"), F.substring(F.bin(size), 1, 5))


def named(source: Column) -> Column:
    """A key without nulls, so that a window and a join on it share one exchange; unnamed() is its inverse."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def unnamed(key: Column) -> Column:
    return F.when(key != "", F.substring(key, F.lit(2), F.length(key)))


def targets(by: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) a source.

    weights repeat over the sources by code point, null last. Water-filling: a source stops at most * its size, and the
    others share what is left by weight. In ascending order of cap over weight, a source is capped where the level that
    the rest would get without it is above its own.
    """
    by = materialize(by)
    few = by.count() <= FEW
    by = before(by, [F.asc_nulls_last("source")], {"place": F.lit(1)}, few)
    by = by.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("place") % len(weights) + 1).cast("int")))
    by = by.withColumn("cap", F.col("source_size") * float(most))
    every = by.agg((F.sum("source_size") * float(share)).alias("whole"), F.sum("weight").alias("every"))
    by = before(by, [F.asc(F.col("cap") / F.col("weight")), F.asc_nulls_last("source")], {"filled": F.col("cap"), "passed": F.col("weight")}, few)
    by = by.join(F.broadcast(every)).withColumns({"left": F.col("whole") - F.col("filled"), "open": F.col("every") - F.col("passed")})  # one row
    by = by.withColumn("capped", F.col("cap") * F.col("open") <= F.col("weight") * F.col("left"))
    by = by if few else materialize(by)
    rest = by.where("NOT capped").agg(F.max(F.struct("open", "left")).alias("rest"))
    return by.join(F.broadcast(rest)).select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("rest.left") * F.col("weight") / F.col("rest.open")).alias("target"))


def placed(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights, share: float, most: int, seed: str, keep: list[str], tie: list[Column], narrow: bool) -> DataFrame:
    """Columns keep of each row, and _source, _size, _source_size, _target and _copies."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    id_ = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    same = F.md5(text)
    rows = docs.withColumns({"_named": named(F.col(source_col).cast("string")), "_size": words_in(F.col(text_col)), "_same": same})
    rows = rows.withColumns({"_level": level(F.col("_size")), "_salt": F.substring(F.md5(F.concat_ws(":", id_, "_same")), 1, 3), "_id": id_, "_tie": F.xxhash64(*tie) if tie else F.lit(0)})
    rows = rows.select(*keep, *CELL, "_size", "_id", "_same", "_tie")
    if narrow:  # the texts are read once
        rows = materialize(rows)
    cells = materialize(rows.groupBy(*CELL).agg(F.count("*").alias("n"), F.sum("_size").alias("size")))
    by = targets(cells.groupBy(unnamed(F.col("_named")).alias("source")).agg(F.sum("size").alias("source_size")), weights, share, most)
    # rows before a cell: those of lower levels, and of the level's lower salts; some hundred levels a source, 4,096 salts a level
    sum_before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    lower = cells.groupBy("_named", "_level").agg(F.sum("n").alias("n")).select("_named", "_level", sum_before(W.partitionBy("_named").orderBy("_level")).alias("_lower"))
    inside = cells.withColumn("_inside", sum_before(W.partitionBy("_named", "_level").orderBy("_salt"))).join(lower, ["_named", "_level"])
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce("source", F.lit("")))), 1, 4), 16, 10).cast("double") / 65536
    told = by.select(named(F.col("source")).alias("_named"), F.col("source").alias("_source"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)).alias("_rate"), offset.alias("_offset"))
    told = materialize(inside.join(told, "_named").select(*CELL, (F.col("_lower") + F.col("_inside")).alias("_earlier"), "_source", "_source_size", "_target", "_rate", "_offset"))
    # the window and the join are on the same keys: rows move once
    ranked = rows.withColumn("_rank", F.row_number().over(W.partitionBy(*CELL).orderBy("_size", "_id", "_same", "_tie"))).join(told, CELL)
    until = lambda k: F.floor(F.col("_offset") + F.col("_rate") * k)
    k = F.col("_earlier") + F.col("_rank")
    return ranked.withColumn("_copies", F.least(until(k) - until(k - 1), F.ceil("_rate")).cast("long"))


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = SEED) -> DataFrame:
    """(id_col, source, size, source_size, target, copies, taken) of each row: copies is how often the mix holds it, taken its words there. One scan of the texts; they don't move."""
    own = docs.select(F.col(id_col).alias("_key"), F.col(text_col).alias("_text"), F.col(source_col).alias("_from"))
    out = placed(own, "_key", "_text", "_from", weights, share, most, seed, ["_key"], [], True)
    return out.select(F.col("_key").alias(id_col), F.col("_source").alias(source_col), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.col("_copies").alias("copies"), (F.col("_copies") * F.col("_size")).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The mix itself: docs's columns and copy (from 1; copy_ where docs has a copy), a row for each copy of mixture(). Two scans; rows move once, to their cells."""
    names, copy = docs.columns, free("copy", docs.columns)
    held = {c: f"_column{i}" for i, c in enumerate(names)}
    own = docs.select(*[docs[c].alias(k) for c, k in held.items()])
    tie = [F.col(held[f.name]) for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and f.name not in (id_col, text_col) and "variant" not in f.dataType.simpleString()]
    out = placed(own, held[id_col], held[text_col], held[source_col], weights, share, most, seed, list(held.values()), tie, False)
    return out.where("_copies > 0").select(*[F.col(k).alias(c) for c, k in held.items()], F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias(copy))
