"""MinHash near-duplicates with tensored banding.

A text's set holds its distinct shingles of words. Two collections of `half` half-bands, `rows` minhashes each, are
computed for a set; every pair (one of the first, one of the second) is the key of a table. So half*half tables of
2*rows minhashes each need only 2*half*rows minhashes. With the defaults (11 half-bands of 3), 121 tables come from 66
minhashes, and two sets of similarity 0.8 share none with a probability of 0.0007.

Sets that are equal form one class first, by a 128-bit digest. A half-band that only one class has is dropped before
pairs are formed. Then:

* in each table's bucket the class with the most shared half-bands is the centre, and every member is held against it on the
  full sets; a centre's set goes to shares of about SHARE members, not to each pair. Classes that the links connect get one
  label,
* buckets that have members of different labels are gathered by their centre's label. Members of other labels (strays) are
  compared with all members, in blocks: by their minhashes first, and those that agree in percent - 20 of 100 places (four
  deviations below) with any other label's on the full sets.

So a group of copies costs one comparison a member, only what its centre doesn't link costs more, and nothing is capped. Where
a key is hot, adaptive execution splits the join's partition: the other side has an exchange of its own for that.

Null doc_ids don't name a component; a component of such rows only has a null component_id and its rows are kept. Rows that
share a doc_id are classed by their own texts. deduplicate() keeps one row of each component by a key of id and text, so null
and shared ids lose no text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ._kernel import Words, mix, numbers, shingles
from ._shared import apart, materialize, release, small_batches, texts

HALF, ROWS, SHARE, BLOCK, LEEWAY = 11, 3, 256, 512, 0.2


class Sets:
    """Shingle sets as sorted 64-bit hashes."""

    def __init__(self, k: int):
        self.words, self.k = Words(), k

    def __call__(self, text: str) -> np.ndarray:
        h = self.words(text.encode())[2]
        if len(h) >= self.k:
            return np.unique(shingles(h, self.k))
        return shingles(h, len(h)) ^ np.uint64(len(h)) if len(h) else h


def digest(items: np.ndarray) -> bytes:
    """128 bits of a set: two sums of its mixed hashes."""
    parts = [mix(items ^ np.uint64(c)).sum(dtype=np.uint64) for c in (0x1F83D9AB, 0x5BE0CD19)]
    return np.array(parts, "<u8").tobytes() + len(items).to_bytes(4, "little")


def sketch(docs: DataFrame, k: int, half: int, rows: int) -> DataFrame:
    """(id, key, n, cls, sig, halves) of each row: set size, digest, the low byte of each minhash, half-band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, n = Sets(k), 2 * half * rows
        factor = (numbers(n, 23) | np.uint64(1))[:, None]
        side = numbers(2 * half, 29)
        weight = numbers(rows, 31) | np.uint64(1)
        for b in small_batches(batches):
            size, cls, sig, keys = [], [], [], []
            for t in texts(b, "text"):
                items = sets(t)
                size.append(len(items))
                cls.append(digest(items) if len(items) else None)
                low = np.full(n, 2**64 - 1, np.uint64)
                for at in range(0, len(items), 2048):
                    np.minimum(low, (items[at : at + 2048] * factor).min(1), out=low)
                low = mix(low)
                sig.append(low.astype(np.uint8).tobytes())
                keys.append(mix((low.reshape(2 * half, rows) * weight).sum(1, dtype=np.uint64) + side).view(np.int64) if len(items) else [])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(size, pa.int64()), pa.array(cls, pa.binary()), pa.array(sig, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["id", "key", "n", "cls", "sig", "halves"])

    return docs.select("id", "text", "key").mapInArrow(run, "id long, key string, n long, cls binary, sig binary, halves array<long>")


def full_sets(docs: DataFrame, k: int) -> DataFrame:
    """(cls, items) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Sets(k)
        for b in small_batches(batches, 64):
            found = [sets(t) for t in texts(b, "text")]
            yield pa.RecordBatch.from_arrays([pa.array([digest(x) for x in found], pa.binary()), pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64()))], ["cls", "items"])

    return docs.select("text").mapInArrow(run, "cls binary, items array<long>")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of all nodes of the edges (a, b): comp is the smallest node reachable. Alternates large and small stars until neither changes an edge."""

    def star(both: DataFrame, large: bool) -> DataFrame:
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        near = both.join(apart(low, "a"), "a")
        out = near.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")) if large else near.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        return out.where("a != b")

    def written(e: DataFrame) -> tuple[DataFrame, dict]:
        """The distinct edges, with their number and checksum counted while they are written."""
        seen = Observation()
        out = materialize(e.distinct().observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")))
        return out, seen.get

    edges, now = written(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    was = None
    while now.get("n") and now != was:
        big = star(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), True)  # as many rows as edges: the small star's distinct does for both
        old, was, (edges, now) = edges, now, written(star(big.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), False))
        release(old)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())


def tables_of(kept: DataFrame, half: int) -> DataFrame:
    """(t, key, cls, pop): each class once a table, for all pairs of its half-bands."""
    left, right = F.filter("halves", lambda x: x["i"] < half), F.filter("halves", lambda x: x["i"] >= half)
    keys = F.flatten(F.transform(left, lambda a: F.transform(right, lambda b: F.struct((a["i"] * half + b["i"] - half).cast("short").alias("t"), F.xxhash64(a["h"], b["h"]).alias("key")))))
    return kept.select("cls", "pop", F.explode(keys).alias("k")).select("k.t", "k.key", "cls", "pop")


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of equal keys, one table after another, from batches sorted by them."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        codes = [np.unique(np.array(table.column(c).to_pylist(), object), return_inverse=True)[1] for c in keys]
        cuts = [0, *(np.flatnonzero(np.any([c[1:] != c[:-1] for c in codes], axis=0)) + 1)]
        yield from (table.slice(at, end - at) for at, end in zip(cuts, cuts[1:]))  # noqa: B905
        held = table.slice(cuts[-1])
    if held is not None and held.num_rows:
        yield held


def objects(column) -> np.ndarray:
    out = np.empty(len(column), object)
    out[:] = column.to_pylist()
    return out


def ordered(x: bytes, y: bytes) -> tuple[bytes, bytes]:
    return (x, y) if x > y else (y, x)


def pairs_of(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.binary()) for i in (0, 1)], ["a", "b"])


def lists_of(column) -> list[np.ndarray]:
    """Each row's sorted hashes."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, offsets = lists.flatten().to_numpy().view(np.uint64), np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
    return [flat[x:y] for x, y in zip(offsets[:-1], offsets[1:], strict=True)]


def centre_links(pairs: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) of pairs (centre, cls, share). A centre's set is sent once to each of its shares."""
    members = pairs.join(items, "cls").select("centre", "share", F.lit(False).alias("first"), "cls", "items")
    centres = pairs.select("centre", "share").distinct().join(items.withColumnRenamed("cls", "centre"), "centre").select("centre", "share", F.lit(True).alias("first"), F.col("centre").alias("cls"), "items")
    dealt = centres.union(members).repartition("centre", "share").sortWithinPartitions("centre", "share", F.desc("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = None, None
        for b in batches:
            found = []
            for first, cls, x in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), lists_of(b.column(4)), strict=True):
                if first:
                    held, own = cls, x.copy()
                    continue
                common = np.count_nonzero(own[np.minimum(np.searchsorted(own, x), len(own) - 1)] == x)
                if 100 * common >= percent * (len(own) + len(x) - common):
                    found.append(ordered(held, cls))
            if found:
                yield pairs_of(found)

    return dealt.mapInArrow(run, "a binary, b binary").distinct()


def in_blocks(members: DataFrame, names: list[str]) -> DataFrame:
    """Members (major, cls, comp, ...) in blocks (major, p, q) of about BLOCK strays and BLOCK members, sorted; a stray stands in its blocks as `first`, too. No task holds a group; what moves grows with n * strays / BLOCK."""
    size = members.groupBy("major").agg(F.count("*").alias("n"), F.count_if(F.expr("comp != major")).alias("s")).where("s > 0")
    sized = members.join(apart(size, "major"), "major").withColumns({"nq": F.ceil(F.col("n") / BLOCK), "np": F.ceil(F.col("s") / BLOCK), "stray": F.expr("comp != major"), "own": F.xxhash64("cls")})
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    as_all = sized.select(*names, F.lit(False).alias("first"), F.explode(upto("np")).alias("p"), F.pmod("own", "nq").alias("q"))
    as_stray = sized.where("stray").select(*names, F.lit(True).alias("first"), F.pmod("own", "np").alias("p"), F.explode(upto("nq")).alias("q"))
    return as_all.union(as_stray).repartition("major", "p", "q").sortWithinPartitions("major", "p", "q")


def opened(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Classes, whether they stand as strays, labels as numbers, and minhashes of a block."""
    cls, first = objects(group.column("cls")), np.array(group.column("first").to_pylist(), bool)
    label = np.unique(objects(group.column("comp")), return_inverse=True)[1]
    return cls, first, label, np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint8).reshape(len(cls), -1)


def alike(members: DataFrame, least: float) -> DataFrame:
    """(major, cls) of members (major, cls, comp, sig) whose minhashes agree with a stray's, or a stray's with theirs, across labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["major", "p", "q"]):
            cls, first, label, sig = opened(group)
            rest, seen = np.flatnonzero(~first), np.zeros(len(cls), bool)
            for x in np.flatnonzero(first):
                near = rest[((sig[rest] == sig[x]).mean(1) >= least) & (label[rest] != label[x])]
                seen[near] = True
                seen[x] |= len(near) > 0
            some = np.flatnonzero(seen)
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array([group.column("major")[0].as_py()] * len(some), pa.binary()), pa.array(cls[some].tolist(), pa.binary())], ["major", "cls"])

    return in_blocks(members, ["major", "cls", "comp", "sig"]).mapInArrow(run, "major binary, cls binary").distinct()


def group_links(members: DataFrame, least: float, percent: int) -> DataFrame:
    """Confirmed links (a, b) between classes of different labels that met in a bucket.

    members: (major, cls, comp, sig, items), a class once a major label. A pair whose labels are linked in the block already
    needs no second look.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["major", "p", "q"]):
            cls, first, label, sig = opened(group)
            items = lists_of(group.column("items"))
            root = list(range(label.max() + 1))

            def find(x, root=root):
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            rest, found = np.flatnonzero(~first), []
            for x in np.flatnonzero(first):
                agree = (sig[rest] == sig[x]).mean(1)
                near = rest[(agree >= least) & (label[rest] != label[x])]
                near = near[np.argsort(-agree[np.searchsorted(rest, near)], kind="stable")]
                own = items[x]
                for at, end in ((0, 16), (16, len(near))):  # the likeliest first: what they link needs no others
                    some = [y for y in near[at:end] if find(label[y]) != find(label[x])]
                    if some:
                        size = np.array([len(items[y]) for y in some])
                        every = np.concatenate([items[y] for y in some])
                        hit = own[np.minimum(np.searchsorted(own, every), len(own) - 1)] == every
                        common = np.add.reduceat(hit.astype(np.int64), np.cumsum(size) - size)
                        for i in np.flatnonzero(100 * common >= percent * (len(own) + size - common)):
                            found.append(ordered(cls[x], cls[some[i]]))
                            root[find(label[some[i]])] = find(label[x])
            if found:
                yield pairs_of(found)

    return in_blocks(members, ["major", "cls", "comp", "sig", "items"]).mapInArrow(run, "a binary, b binary").distinct()


def row_key(id_col: str, text_col: str) -> Column:
    """Tells rows apart whose id or text differs."""
    return F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.coalesce(F.md5(F.col(text_col)), F.lit("null")))


def labelled(docs: DataFrame, k: int, percent: int, half: int, rows: int) -> DataFrame:
    """(id, key, n, comp, component) of rows (id, text, key): comp names the component, component is its smallest id; both are null where a text has no words."""
    seen = materialize(sketch(docs, k, half, rows))
    sets = seen.where("n > 0")
    classes = sets.groupBy("cls").agg(F.first("sig").alias("sig"), F.first("halves").alias("halves"))
    each = classes.select("cls", "sig", F.posexplode("halves").alias("i", "h"))
    shared = each.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    halves = F.array_sort(F.collect_list(F.struct("i", "h")))
    kept = materialize(each.join(apart(shared, "h"), "h").groupBy("cls").agg(F.first("sig").alias("sig"), F.sum("n").alias("pop"), halves.alias("halves")))

    # each bucket's most popular class is held against the others; a class that shares many half-bands is one of many
    tables = tables_of(kept, half)
    buckets = tables.groupBy("key").agg(F.count("*").alias("n"), F.max(F.struct("pop", "cls")).alias("centre")).where("n > 1").select("key", F.col("centre.cls").alias("centre"))
    buckets = materialize(tables.join(apart(buckets, "key"), "key"))
    share = F.pmod(F.xxhash64("cls"), F.ceil(F.col("pop") / (2 * SHARE)))
    pairs = buckets.where("cls != centre").select("centre", "cls", share.alias("share")).distinct()

    # full sets of the classes in any bucket
    inside = buckets.select("cls").distinct()
    one_row = sets.join(inside, "cls", "left_semi").groupBy("cls").agg(F.min("id").alias("id"))
    again = docs.join(one_row.select("id").distinct(), "id", "left_semi").union(docs.where("id IS NULL"))
    items = materialize(full_sets(again, k).dropDuplicates(["cls"]).join(inside, "cls", "left_semi"))

    links = materialize(centre_links(pairs, items, percent))
    comp = materialize(components(links))

    # members of one bucket with different labels
    marked = buckets.join(comp, F.col("cls") == F.col("node"), "left").select("key", "cls", "centre", F.coalesce("comp", "cls").alias("comp"))
    open_ = marked.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max(F.when(F.expr("cls = centre"), F.col("comp"))).alias("major"), F.count("*").alias("n")).where("lo < hi AND n > 2").select("key", "major")
    unsettled = marked.join(apart(open_, "key"), "key").select("major", "cls", "comp").distinct()
    least = percent / 100 - LEEWAY
    members = materialize(unsettled.join(kept.select("cls", "sig"), "cls").select("major", "cls", "comp", "sig"))
    members = materialize(members.join(alike(members, least), ["major", "cls"], "left_semi"))
    more = group_links(members.join(items, "cls"), least, percent)
    stars = comp.select(F.col("node").alias("a"), F.col("comp").alias("b"))  # what the first links connect, in fewer steps
    comp = materialize(components(stars.union(more)))
    release(kept, buckets, items, links, members)

    # back to rows: the smallest id of all classes of a component
    named = sets.groupBy("cls").agg(F.min("id").alias("low")).join(comp, F.col("cls") == F.col("node"), "left").select("cls", "low", F.coalesce("comp", "cls").alias("comp"))
    named = named.join(apart(named.groupBy("comp").agg(F.min("low").alias("component")), "comp"), "comp").select("cls", "comp", "component")
    return seen.select("id", "key", "n", "cls").join(apart(named, "cls"), "cls", "left").select("id", "key", "n", "comp", "component")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, percent: int = 80, half: int = HALF, rows: int = ROWS) -> DataFrame:
    """(id_col, n_shingles, component_id, kept): rows linked where 100 * intersection >= percent * union of their shingle sets."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.lit(None).cast("string").alias("key"))
    out = labelled(docs, k, percent, half, rows).select("id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, percent: int = 80, half: int = HALF, rows: int = ROWS) -> DataFrame:
    """One row of docs for each component, with docs's columns: of the smallest id (null last), then the smallest row key.

    Texts without words have no component: they all stay, except rows that repeat both id and text.
    """
    key = row_key(id_col, text_col)
    seen = labelled(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), key.alias("key")), k, percent, half, rows)
    first = seen.where("n > 0").groupBy("comp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("m")).select("m.key")
    stay = materialize(first.union(seen.where("n = 0").select("key").distinct())).select(F.col("key").alias("_row"))
    return docs.withColumn("_row", key).join(stay, "_row", "left_semi").dropDuplicates(["_row"]).drop("_row")
