"""Spans of a pattern's matches, as DataFrame expressions.

Spark's regexp functions tell what matched but not where. Here matches are put between two marks, the text is split at the
first, and the lengths of the pieces add up to the matches' places, counted in code points. Marks that a text holds itself
become a third control character first, which is as long and in none of the patterns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN, CLOSE, OTHER = "\x01", "\x02", "\x03"
BLOCK = 256
EMPTY = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unmarked(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.when(F.contains(text, F.lit(OPEN)) | F.contains(text, F.lit(CLOSE)), F.translate(text, OPEN + CLOSE, OTHER + OTHER)).otherwise(text)


def running(lengths: Column, i: Column) -> Column:
    """Sum of the first i lengths; blocks keep it from costing i steps a call."""
    start = F.floor(i / BLOCK).cast("int") * BLOCK
    return F.aggregate(F.slice(lengths, start + 1, i - start), F.lit(0), lambda a, x: a + x)


def spans(text: Column, pattern: str, kind: Column | str, rank: int, only: Column | None = None) -> Column:
    """Array of (start, rank, end, kind, value) of the leftmost non-overlapping matches in an unmarked text. only: where to look at all."""
    name = F.lit(kind) if isinstance(kind, str) else kind
    none = F.array().cast(EMPTY)

    def places(pieces: Column) -> Column:
        lengths = F.transform(pieces, lambda p, i: F.length(p) - F.when(i > 0, 1).otherwise(0))

        def within(lengths: Column) -> Column:
            blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(lengths) / BLOCK).cast("int")), lambda b: F.aggregate(F.slice(lengths, b * BLOCK + 1, BLOCK), F.lit(0), lambda a, x: a + x))

            def span(i: Column, before: Column) -> Column:
                at = F.get(before, F.floor(i / BLOCK).cast("int")) + running(lengths, i)
                value = F.substring_index(F.get(pieces, i), CLOSE, 1)
                return let(at, lambda at: let(value, lambda v: F.struct(at.alias("start"), F.lit(rank).alias("rank"), (at + F.length(v)).alias("end"), name.alias("kind"), v.alias("value"))))

            before = lambda sums: F.transform(sums, lambda _, b: F.aggregate(F.slice(sums, F.lit(1), b), F.lit(0), lambda a, x: a + x))
            every = F.sequence(F.lit(1), F.size(lengths) - 1)
            return let(blocks, lambda sums: let(before(sums), lambda earlier: F.transform(every, lambda i: span(i, earlier))))

        return F.when(F.size(pieces) > 1, let(lengths, within)).otherwise(none)

    found = let(F.split(F.regexp_replace(text, pattern, f"{OPEN}$0{CLOSE}"), OPEN), places)
    return found if only is None else F.when(only, found).otherwise(none)


def in_order(found: Column) -> Column:
    """By start, then by the kinds' order."""
    return F.array_sort(found)


def told(found: Column) -> Column:
    """kind:start:end of each, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])
