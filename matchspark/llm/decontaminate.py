"""Benchmark decontamination by SimHash windows.

Each benchmark item belongs to a window size, the largest of SIZES that leaves room for STEP alignments in it. Windows of
that many words at every STEP-th word of a document, and at every word of the item, get a 64-bit SimHash of their words,
weighted by length.

A multi-index finds all of the item's windows within RADIUS: fingerprints are cut into four blocks of 16 bits, and of two
fingerprints at most 7 bits apart some block differs in one bit at most. Items are entered under each block's value and its
16 neighbours, so a document's window asks four times.

Windows miss near copies that fall between the steps or are too altered, so each item has seeds too: the shingles that the
fewest items have, as many as weigh more than 1 - LEAST of the item. What lacks all of an item's seeds can't be similar
enough; each word of a document is looked up among them, so every passage that is similar enough is found, wherever it stands.

Then an exact comparison decides: the highest weighted Jaccard similarity of the shingles of five words (multisets; a shingle
weighs what its words do) of the item and of any passage of the document, wherever it begins and ends. So words that were
replaced, inserted or left out cost what their shingles weigh.

Words are runs of letters and digits in lower case (bytes beyond ASCII count as letters). Items of fewer than five words are
one shingle of as many words, looked up at each word too. Null or empty texts on either side match nothing; repeated items each have their own rows; rows that share a
doc_id are looked at separately, and their best similarity is told.

The benchmark is split into blocks of at most ITEMS items and about BYTES bytes. Where there are several, they go to the
executors one after another: each block's finds are written and its index is dropped before the next one is made, so neither
what is broadcast nor what a worker holds grows with either table. An empty benchmark, or a table without rows, has no finds.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ._kernel import Words, shingles
from ._shared import free, materialize, texts

SIZES = [1, 2, 3, 4, 6, *(b << e for e in range(9) for b in (8, 12))]
STEP, RADIUS, SHINGLE, LEAST, HEAVY = 4, 7, 5, 0.8, 15
ITEMS, BYTES, CHUNK, PROBE = 20_000, 1 << 24, 1 << 14, 20  # bits of a hash that are probed first
NOT_WORD = bytes(x for x in range(128) if not chr(x).isalnum())


def words_of(text: str, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and weights (bytes, HEAVY at most)."""
    start, end, h = words(text.lower().encode())
    return h, np.minimum(end - start, HEAVY).astype(np.uint8)


def planes(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Running sums of weight, for each bit of the hash: (words + 1, 64). They wrap; differences over a window don't."""
    out = np.zeros((len(h) + 1, 64), np.uint16)
    np.cumsum(np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1) * w[:, None], axis=0, dtype=np.uint16, out=out[1:])
    return out


def signs(sums: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Fingerprints of windows: a bit is set where more than half of the weight has it."""
    return np.packbits(sums > (weight // 2)[:, None], axis=1).view(np.uint64).ravel()


def weighed(h: np.ndarray, w: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and weight of each k words in a row."""
    run = np.concatenate(([0], np.cumsum(w, dtype=np.int64)))
    return shingles(h, k), run[k:] - run[:-k]


class Index:
    """The multi-index of one block of a benchmark."""

    def __init__(self, items: list[tuple[int, str]]):
        words = Words(NOT_WORD)
        self.items, by = [], {}
        for i, text in items:
            h, w = words_of(text or "", words)
            if not len(h):
                continue
            size = max(x for x in SIZES if x <= max(1, len(h) - STEP + 1))
            sums, weight = planes(h, w), np.concatenate(([0], np.cumsum(w, dtype=np.int64)))
            f = signs(sums[size:] - sums[:-size], weight[size:] - weight[:-size])
            by.setdefault(size, []).append((f, np.full(len(f), len(self.items), np.int32), np.arange(len(f), dtype=np.int32)))
            s, each = weighed(h, w, min(SHINGLE, len(h)))
            own, first, copies = np.unique(s, return_index=True, return_counts=True)
            self.items.append((i, len(h), own, copies, each[first] * copies))
        self.by = {}
        for size, parts in sorted(by.items()):
            f, item, offset = (np.concatenate(x) for x in zip(*parts, strict=True))
            flips = np.concatenate(([0], 1 << np.arange(16))).astype(np.uint16)
            blocks = []
            for b in f.view(np.uint16).reshape(-1, 4).T:
                keys = (b[:, None] ^ flips).ravel()
                order = np.argsort(keys, kind="stable")
                blocks.append((np.searchsorted(keys[order], np.arange(65537)).astype(np.int32), (order // 17).astype(np.int32)))
            self.by[size] = (f, item, offset, blocks)
        self.seeds = self._seeds()

    def _seeds(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """By words a shingle: (probe, hashes, where each one's items start, items)."""
        if not self.items:
            return {}
        every, held = np.unique(np.concatenate([x[2] for x in self.items]), return_counts=True)
        by: dict[int, list] = {}
        for i, (_, n, own, _, weight) in enumerate(self.items):
            order = np.lexsort((own, held[np.searchsorted(every, own)]))
            whole = int(weight.sum())
            enough = np.flatnonzero(whole - np.cumsum(weight[order]) < LEAST * whole - 1e-9)[0]
            seeds = own[order[: enough + 1]]
            by.setdefault(min(SHINGLE, n), []).append((seeds, np.full(len(seeds), i)))
        out = {}
        for k, parts in by.items():
            seeds, item = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(seeds, kind="stable")
            keys, start = np.unique(seeds[order], return_index=True)
            probe = np.zeros(1 << PROBE, bool)
            probe[keys >> np.uint64(64 - PROBE)] = True
            out[k] = (probe, keys, np.append(start, len(order)), item[order])
        return out

    def seeded(self, h: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, int]]:
        """(document, item) where a document has one of the item's seeds."""
        for k, (probe, keys, start, item) in self.seeds.items():
            s = shingles(h, k)
            hit = np.flatnonzero(probe[s >> np.uint64(64 - PROBE)])
            hit = hit[doc[hit] == doc[hit + k - 1]]
            at = np.minimum(np.searchsorted(keys, s[hit]), len(keys) - 1)
            same = keys[at] == s[hit]
            for d, x in set(zip(doc[hit[same]].tolist(), at[same].tolist(), strict=True)):
                yield from ((d, i) for i in item[start[x] : start[x + 1]].tolist())

    def best(self, h: np.ndarray, w: np.ndarray, item: int) -> tuple[float, int]:
        """The highest similarity of the item and a passage of one document, and the passage's first word; of equal ones the earliest."""
        _, n, own, copies, weight = self.items[item]
        k, whole = min(SHINGLE, n), int(weight.sum())
        if len(h) < k:
            return 0.0, 0
        s, each = weighed(h, w, k)
        at = np.minimum(np.searchsorted(own, s), len(own) - 1)
        hit = own[at] == s
        place = np.flatnonzero(hit)  # a best passage begins and ends with shingles of the item
        if not len(place):
            return 0.0, 0
        run, known = np.concatenate(([0], np.cumsum(each))), np.concatenate(([0], np.cumsum(np.where(hit, each, 0))))
        end = np.searchsorted(run, run[place] + whole / LEAST + 1e-6, side="right") - 1  # longer ones are below LEAST
        most = np.minimum(known[end] - known[place], whole) / whole  # repeats counted as often as they stand
        high = np.searchsorted(place, end)
        # a repeat counts unless the passage has as many before it as the item has in all
        key = at[place]
        by_key = np.argsort(key, kind="stable")
        back, before = np.full(len(place), -1), np.arange(len(place)) - copies[key[by_key]]
        full = (before >= 0) & (key[by_key[before]] == key[by_key])
        back[by_key[full]] = place[by_key[before[full]]]
        order = np.flatnonzero(most >= LEAST - 1e-9)
        top, word = 0.0, 0
        for x in order[np.argsort(-most[order], kind="stable")].tolist():
            if top == 1.0 or most[x] < top:
                break
            a, until = int(place[x]), int(high[x])
            common = np.cumsum(np.where(back[x:until] < a, each[place[x:until]], 0))
            alike = common / (whole + run[place[x:until] + 1] - run[a] - common)
            found = float(alike.max())
            if found >= LEAST and (found, -a) > (top, -word):
                top, word = found, a
        return top, word

    def near(self, size: int, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (window, item window) at most RADIUS bits apart."""
        own, _, _, blocks = self.by[size]
        left, right = [], []
        for (start, order), key in zip(blocks, f.view(np.uint16).reshape(-1, 4).T, strict=True):
            n = start[key.astype(np.int32) + 1] - start[key]
            hit = np.flatnonzero(n)
            if not len(hit):
                continue
            n = n[hit]
            x = np.repeat(hit, n)
            at = np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n)
            y = order[start[key[x]] + at]
            close = np.bitwise_count(f[x] ^ own[y]) <= RADIUS
            left.append(x[close])
            right.append(y[close])
        if not left:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs = np.unique(np.stack((np.concatenate(left), np.concatenate(right))), axis=1)
        return pairs[0], pairs[1]

    def windows(self, h: np.ndarray, w: np.ndarray, doc: np.ndarray, first: int, until: int) -> Iterator[tuple[int, int]]:
        """(word, item) where windows that start in first..until say that an item begins; the word is counted in these arrays."""
        sums, weight = planes(h, w), np.concatenate(([0], np.cumsum(w, dtype=np.int64)))
        edges = np.flatnonzero(np.diff(doc, prepend=-1))
        ends = np.append(edges[1:], len(h))
        for size, (_, item, offset, _) in self.by.items():
            start = np.arange(first, min(until, len(h) - size + 1), STEP)
            found = []
            if len(start):
                a, z = start[0], start[-1] + 1
                whole = doc[a:z:STEP] == doc[a + size - 1 : z + size - 1 : STEP]
                f = signs(sums[a + size : z + size : STEP] - sums[a:z:STEP], weight[a + size : z + size : STEP] - weight[a:z:STEP])
                found.append((start[whole], f[whole]))
            short = np.flatnonzero((ends - edges < size) & (ends - edges >= 0.7 * size) & (edges >= first) & (edges < until))
            if len(short):  # documents a little shorter than the window are one window
                a, z = edges[short], ends[short]
                found.append((a, signs(sums[z] - sums[a], weight[z] - weight[a])))
            for at, f in found:
                x, y = self.near(size, f)
                yield from zip((at[x] - offset[y]).tolist(), item[y].tolist(), strict=True)

    def leaks(self, h: np.ndarray, w: np.ndarray, doc: np.ndarray) -> dict[tuple[int, int], tuple[float, int]]:
        """(document, item) -> (similarity, word of the document where it begins)."""
        edges = np.searchsorted(doc, np.arange(doc[-1] + 2))
        pairs = set(self.seeded(h, doc))
        reach = max(self.by, default=0)
        for at in range(0, len(h), CHUNK):
            end = min(len(h), at + CHUNK + reach)
            for place, item in set(self.windows(h[at:end], w[at:end], doc[at:end], 0, CHUNK)):
                middle = place + at + self.items[item][1] // 2
                pairs |= {(int(doc[min(max(x, 0), len(doc) - 1)]), item) for x in (place + at, middle)}
        out = {}
        for d, item in sorted(pairs):
            found = self.best(h[edges[d] : edges[d + 1]], w[edges[d] : edges[d + 1]], item)
            if found[0]:
                out[d, item] = found
        return out


def _parts(benchmark: DataFrame, id_col: str, text_col: str) -> int:
    """Blocks that the benchmark is cut into; 1 at least."""
    n, size = benchmark.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()
    return max(1, -(-n // ITEMS), -(-size // BYTES))


def _block(benchmark: DataFrame, id_col: str, text_col: str, part: int, parts: int) -> list[tuple[object, str]]:
    rows = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return [(r.id, r.text) for r in (rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part) if parts > 1 else rows).collect()]


def _found(index: Index, batch: pa.RecordBatch, at: int, words: Words) -> dict[tuple[int, int], tuple[float, int]]:
    got = [words_of(t, words) for t in texts(batch, batch.schema.names[at])]
    if not got:
        return {}
    h, w = (np.concatenate(x) for x in zip(*got, strict=True))
    return index.leaks(h, w, np.repeat(np.arange(len(got)), [len(x) for x, _ in got])) if len(h) else {}


def _batches(batches: Iterator[pa.RecordBatch], rows: int = 128) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def _over_blocks(rows: DataFrame, benchmark: DataFrame, item_col: str, item_text: str, schema: T.StructType, tell) -> DataFrame:
    """What tell(batch, index, found) yields for each batch of rows and block of the benchmark. One block is left lazy; several run one by one."""
    sc, parts = rows.sparkSession.sparkContext, []
    held = list(range(_parts(benchmark, item_col, item_text)))
    at = rows.columns.index("text")
    for part in held:
        sent = sc.broadcast(Index(_block(benchmark, item_col, item_text, part, len(held))))

        def run(batches, sent=sent):
            index, words = sent.value, Words(NOT_WORD)
            for b in _batches(batches):
                yield from tell(b, index, _found(index, b, at, words))

        out = rows.mapInArrow(run, schema)
        if len(held) > 1:
            out = materialize(out)
            sent.destroy()
        parts.append(out)
    return functools.reduce(DataFrame.union, parts)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id_col, item_col, similarity, first_word): the items that stand in each document. One scan of docs a block of the benchmark, no shuffle of texts."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("item", benchmark.schema[item_col].dataType), T.StructField("similarity", T.DoubleType()), T.StructField("first_word", T.LongType())])
    kinds = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])

    def tell(b, index, found):
        if found:
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([d for d, _ in found])).cast(kinds.field(0).type), pa.array([index.items[i][0] for _, i in found], kinds.field(1).type), pa.array([round(s, 6) for s, _ in found.values()], pa.float64()), pa.array([p for _, p in found.values()], pa.int64())], schema=kinds)

    out = _over_blocks(rows, benchmark, item_col, item_text, schema, tell)
    best = out.groupBy("id", "item").agg(F.max(F.struct("similarity", (-F.col("first_word")).alias("at"))).alias("m"))
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), F.col("m.similarity"), (-F.col("m.at")).alias("first_word"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of docs in which no item stands, with docs's columns. No shuffle where the benchmark is one block; else the texts' hashes that leak are joined."""
    if _parts(benchmark, item_col, item_text) == 1:
        at = docs.columns.index(text_col)
        sent = docs.sparkSession.sparkContext.broadcast(Index(_block(benchmark, item_col, item_text, 0, 1)))

        def run(batches):
            words = Words(NOT_WORD)
            for b in _batches(batches):
                found = {d for d, _ in _found(sent.value, b, at, words)}
                yield b.take(pa.array([i for i in range(b.num_rows) if i not in found], pa.int64())) if found else b

        return docs.mapInArrow(run, docs.schema)
    schema = T.StructType([T.StructField("hash", T.StringType())])

    def tell(b, index, found):
        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(sorted({d for d, _ in found}), pa.int64())).cast(pa.string())], ["hash"])

    rows = docs.select(F.sha2(text_col, 256).alias("hash"), F.col(text_col).alias("text"))
    leaked = materialize(_over_blocks(rows, benchmark, item_col, item_text, schema, tell).distinct())
    name = free("hash", docs.columns)
    return docs.join(leaked.withColumnRenamed("hash", name), F.sha2(docs[text_col], 256) == F.col(name), "left_anti")
