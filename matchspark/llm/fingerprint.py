"""Document fingerprints: a homomorphic multiset hash over paragraphs.

Each paragraph (line) is hashed to one wide vector and a text's fingerprint is the sum of its paragraphs'
vectors, lane by lane modulo a power of two. So the order of paragraphs doesn't matter, equal multisets of
paragraphs give equal fingerprints, and inserting or deleting a paragraph is adding or subtracting a vector.

Two kinds of lanes make up a vector:

* 16 lanes modulo 2^64, uniform in the paragraph's bytes (SHAKE-256). Fingerprints are equal where all lanes are.
* 256 lanes modulo 2^32 that count the paragraph's three-word shingles with signs (a count sketch). Read as signed
  numbers, their cosine estimates how many shingles two texts share; its standard error is about 1/16.

Null and empty texts hold one empty paragraph. Rows that share a doc_id are separate documents, ordered by the MD5 of their
texts; null doc_ids come first. A table without rows gives none; a single row follows itself.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._kernel import Words, shingles
from ._shared import small_batches, texts

EXACT, SKETCH, SHINGLE = 16, 256, 3
BYTES, WIDTH = 1 << 27, 64


class Fingerprint:
    """Adds up paragraphs. A fingerprint is a pair of arrays: uint64 exact lanes, uint32 sketch lanes."""

    def __init__(self):
        self.words = Words(lower=False)

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        data = text.encode()
        exact = np.zeros(EXACT, np.uint64)
        if len(data) < 1 << 16:
            joined = b"".join(hashlib.shake_256(p).digest(8 * EXACT) for p in data.split(b"\n"))
            exact += np.frombuffer(joined, "<u8").reshape(-1, EXACT).sum(0, dtype=np.uint64)
        else:
            for p in data.split(b"\n"):
                exact += np.frombuffer(hashlib.shake_256(p).digest(8 * EXACT), "<u8")
        start, _, h = self.words(data)
        if not len(h):
            return exact, np.zeros(SKETCH, np.uint32)
        breaks = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
        paragraph = np.searchsorted(breaks, start)
        k = SHINGLE
        item = shingles(h, k)[paragraph[: max(0, len(h) - k + 1)] == paragraph[k - 1 :]]
        first = np.flatnonzero(np.diff(paragraph, prepend=-1))
        short = first[np.diff(first, append=len(h)) < k]  # paragraphs of one or two words are an item as they are
        if len(short):
            size = np.diff(first, append=len(h))
            two = h[short] + np.where(size[np.searchsorted(first, short)] == 2, h[np.minimum(short + 1, len(h) - 1)] * np.uint64(3), np.uint64(0))
            item = np.concatenate((item, two))
        counts = np.bincount((item >> np.uint64(40)).astype(np.int64) & (2 * SKETCH - 1), minlength=2 * SKETCH)
        return exact, (counts[:SKETCH] - counts[SKETCH:]).astype(np.uint32)

    def edit(self, fingerprint, old: str, new: str):
        """The fingerprint after the paragraphs of old went and those of new came."""
        (e, s), (oe, os), (ne, ns) = fingerprint, self.of(old), self.of(new)
        return e - oe + ne, s - os + ns


def as_text(fingerprint) -> str:
    return base64.b64encode(fingerprint[0].astype("<u8").tobytes() + fingerprint[1].astype("<u4").tobytes()).decode()


def likeness(a, b) -> float:
    """1 for equal fingerprints, else the cosine of their sketches, 0 at least."""
    if (a[0] == b[0]).all() and (a[1] == b[1]).all():
        return 1.0
    x, y = a[1].view(np.int32).astype(np.float64), b[1].view(np.int32).astype(np.float64)
    size = np.sqrt((x @ x) * (y @ y))
    return float(min(1.0, max(0.0, round(x @ y / size, 6)))) if size else 0.0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns id_col and fingerprint of each row; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Fingerprint()
        for b in small_batches(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([as_text(own.of(t)) for t in texts(b, "text")], pa.string())], ["id", "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, fingerprint string").withColumnRenamed("id", id_col)


def bounds_of(ids: DataFrame, n: int) -> list[tuple[int | None, str]]:
    """At most about 2 * n bounds (id, hash) that cut the rows into ranges of about equal numbers. An id that has more rows than a range should is cut by its rows' hashes."""
    rows = ids.count()
    cuts = ids.where("id IS NOT NULL").select(F.col("id").cast("double").alias("id")).approxQuantile("id", [i / n for i in range(1, n)], 1 / (4 * n)) if n > 1 else []
    out = {(int(x), "") for x in cuts}
    for r in ids.groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") > max(1, 2 * rows // n)).collect():  # n / 2 rows at most
        parts = -(-r.n * n // rows)
        out |= {(r.id, f"{i * 16**8 // parts:08x}") for i in range(1, parts)} | ({(r.id, "")} if r.id is not None else set())
    return sorted(out, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))


def bucket_of(bounds: list[tuple[int | None, str]]) -> Column:
    """How many bounds are at or before a row (id, h): looked up among every WIDTH-th of them, then among WIDTH."""
    if not bounds:
        return F.lit(0)
    row = F.struct(F.col("id"), F.col("h"))
    listed = [F.struct(F.lit(i).cast("long").alias("id"), F.lit(h).alias("h")) for i, h in bounds]
    blocks = [listed[at : at + WIDTH] for at in range(0, len(listed), WIDTH)]
    before = F.size(F.filter(F.array(*[b[0] for b in blocks]), lambda x: x <= row))
    own = F.get(F.array(*[F.array(*b) for b in blocks]), before - 1)
    return F.when(before == 0, 0).otherwise((before - 1) * WIDTH + F.size(F.filter(own, lambda x: x <= row)))


def in_order(docs: DataFrame) -> DataFrame:
    """Rows (bucket, id, text, own) in buckets of neighbouring rows by id and hash, sorted within; the first row of the next bucket, or of the first one after the last, follows each bucket's own rows with own = false.

    Buckets hold about BYTES bytes of text, or less. One row (bucket, id, hash) a bucket goes to the driver, so that each
    bucket knows what follows it.
    """
    n = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    hashed = docs.select("id", F.substring(F.md5(F.coalesce("text", F.lit(""))), 1, 8).alias("h"), "text")
    bounds = bounds_of(docs.select("id"), max(n, -(-size // BYTES)))
    numbered = hashed.select(bucket_of(bounds).cast("int").alias("bucket"), "id", "h", "text")
    first = sorted(((r.bucket, r.m.id, r.m.h) for r in numbered.groupBy("bucket").agg(F.min(F.struct("id", "h")).alias("m")).collect()), key=lambda x: x[0])
    key = lambda i, h: F.concat_ws(":", F.coalesce(i.cast("string"), F.lit("-")), h)
    pairs = [F.lit(x) for at, (_, i, h) in enumerate(first) for x in (f"{'-' if i is None else i}:{h}", first[at - 1][0])]
    follows = F.try_element_at(F.create_map(*pairs), key(F.col("id"), F.col("h"))) if pairs else F.lit(None).cast("int")
    places = F.array_compact(F.array(F.struct(F.col("bucket"), F.lit(True).alias("own")), F.when(follows.isNotNull(), F.struct(follows.alias("bucket"), F.lit(False).alias("own")))))
    placed = numbered.select("id", "h", "text", F.explode(places).alias("p")).select("p.bucket", "p.own", "id", "h", "text")
    return placed.repartition("bucket").sortWithinPartitions("bucket", F.desc("own"), F.asc_nulls_first("id"), "h", "text").drop("h")


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = 4) -> DataFrame:
    """Fingerprint each text, its edited text and their likeness, and that to the next document by ascending id.

    The edited text: the last 1/share of the code points replaced by as many of the next document's first, or all of it.
    Texts move once, to their id's range; the edited text's fingerprint comes from the own one by deletion and insertion.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Fingerprint()
        held = None

        def finish(text, a, following, b):
            n = len(text) // share
            new = text[: len(text) - n] + following[:n]
            keep = text.rfind("\n", 0, len(text) - n) + 1  # the paragraphs before stay
            c = own.edit(a, text[keep:], new[keep:]) if new != text else a
            return len(text), hashlib.sha256(new.encode()).hexdigest(), as_text(a), as_text(c), likeness(a, c), likeness(a, b)

        for b in small_batches(batches):
            ids, done = [], []
            for bucket, mine, i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), texts(b, "text"), strict=True):
                if held is not None and held[0] == bucket or mine:
                    a = own.of(text)
                    if held is not None and held[0] == bucket:
                        ids.append(held[1])
                        done.append(finish(held[2], held[3], text, a))
                    held = (bucket, i, text, a) if mine else None
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip([ids, *zip(*done, strict=True)], [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2], strict=True)], NAMES)

    rows = in_order(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")))
    kinds = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return rows.mapInArrow(run, kinds).withColumnRenamed("id", id_col)


NAMES = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
