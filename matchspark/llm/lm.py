"""Masked pseudo-likelihood scores from a bidirectional window network in numpy.

A word is a 64-bit hash of its letters in lower case. Words are counted in the whole corpus, in a table that grows with it, and
ordered by count into CLASSES classes of SUBS leaves each, of about equal mass, so that a frequent word is a leaf of its own.
A network with one hidden layer reads the classes of the WINDOW words on either side, the word itself left out, and predicts
the word's class, then its leaf within the class (a softmax of two levels, both of which see the sides). Words that share a
leaf have their shares of the corpus counts, without the occurrence that is predicted. A document's score is the sum of
log p(class | sides) + log p(leaf | class, sides) + log p(word | leaf) over its words. n_novel counts its words that occur
nowhere else. Under a given model nothing is left out, and words that its corpus lacks share the place of one that occurs half
a time.

Texts are read once, into blocks: a block has many documents, its distinct words and each word's place among them. The blocks'
words meet the table of words in a join, so no task and not the driver holds the vocabulary; leaves are told by cells of
counts, a number of them that is bounded whatever the corpus holds.

Documents are dealt by hash into shards, whose number follows the root of the number of words and not the partitions, and each
shard's by hash into ROUNDS parts. In a round every shard trains from the same parameters on its part, in the order of the
hashes; then the network is the mean of the shards', weighted by words, added up in whole numbers by GROUPS tasks. So every
word trains once, and file splits, cores and the order of rows change nothing. The driver gets at most 2^16 cells, and GROUPS
times about 40,000 parameters a round.

Null and empty texts have no words, score 0 and no mean. Repeated rows score alike (to the rounding of 32-bit sums), train
as often as they stand, and ties of hashes are equal documents. Ids may be null or repeated. A table without rows gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._kernel import Words
from ._shared import materialize, release, small_batches, texts

CLASSES, SUBS, HIDDEN, WINDOW, BATCH, RATE, ROUNDS = 64, 32, 16, 2, 4096, 0.02, 3
SHARD, GROUPS = 1 << 18, 16  # shards: the root of the words over SHARD
FIXED = 1 << 16  # parameters travel as whole numbers of 1/FIXED
BLOCK = 1 << 20  # words a block, more only where one batch has more
EXACT, STEPS, SLICES = 64, 16, 64  # counts below EXACT have a level each, others STEPS an octave; a level's words are cut by hash
NEVER = -30.0  # log-odds of classes and leaves without words


def cell(words: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The cell of each word with its count: below 2^16."""
    level = np.where(n < EXACT, n, EXACT + np.floor(STEPS * np.log2(np.maximum(n, EXACT) / EXACT))).astype(np.int64)
    return level * SLICES + (words.view(np.uint64) % np.uint64(SLICES)).astype(np.int64)


class Cells:
    """Leaves of cells, from each cell's number of words and sum of counts. Cell 0 is that of a word not seen."""

    def __init__(self, at: np.ndarray, words: np.ndarray, counts: np.ndarray):
        at = np.append(at, 0)
        mass = np.append(counts + 0.5 * words, 0.5)
        order = np.lexsort((at % SLICES, -(at // SLICES)))
        middle = np.cumsum(mass[order]) - mass[order] / 2
        self.of = np.zeros(1 << 16, np.uint16)
        self.of[at[order]] = np.minimum((middle / mass.sum() * CLASSES * SUBS).astype(np.int64), CLASSES * SUBS - 1)
        self.total = np.bincount(self.of[at], weights=mass, minlength=CLASSES * SUBS)
        self.tokens = int(counts.sum())

    def __call__(self, words: np.ndarray, n: np.ndarray, own: bool) -> tuple[np.ndarray, np.ndarray]:
        """Leaf and log p(word | leaf) of words that the corpus has n times; own: one of these is the word itself, and left out."""
        leaf = self.of[cell(words, n)]
        n, total = (n - 1, self.total[leaf] - 1) if own else (n, self.total[leaf])
        return leaf, np.log((n + 0.5) / np.maximum(total, 0.5))


class Vocabulary:
    """Table (word, n) of all words, and its cells."""

    def __init__(self, counts: DataFrame):
        def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, total = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
            for b in batches:
                n = b.column(1).to_numpy()
                at = cell(b.column(0).to_numpy(), n)
                words += np.bincount(at, minlength=1 << 16)
                np.add.at(total, at, n)
            seen = np.flatnonzero(words)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (seen, words[seen], total[seen])], ["cell", "words", "n"])

        rows = counts.mapInArrow(fill, "cell long, words long, n long").groupBy("cell").agg(F.sum("words").alias("words"), F.sum("n").alias("n")).collect()
        self.table = counts
        self.cells = Cells(*(np.array([r[i] for r in rows], np.int64) for i in range(3)))


class Network:
    """One hidden layer over a table for each place beside the word. Class CLASSES stands for the text's edge."""

    def __init__(self, params: np.ndarray | None = None, mass: np.ndarray | None = None):
        self.shapes = [(2 * WINDOW, CLASSES + 1, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,), (CLASSES, HIDDEN, SUBS), (CLASSES, SUBS)]
        sizes = [int(np.prod(s)) for s in self.shapes]
        self.cuts = np.cumsum(sizes)[:-1]
        if params is None:  # starts at the leaves' masses, whatever the sides
            params = np.random.default_rng(5).normal(0, 0.3, sum(sizes))
            _, _, out, top, out2, top2 = self.parts(params)
            whole = (np.ones(CLASSES * SUBS) if mass is None else mass).reshape(CLASSES, SUBS)
            out[:], out2[:] = 0, 0
            with np.errstate(divide="ignore", invalid="ignore"):
                top[:] = np.maximum(np.nan_to_num(np.log(whole.sum(1) / whole.sum()), nan=NEVER, neginf=NEVER), NEVER)
                top2[:] = np.maximum(np.nan_to_num(np.log(whole / whole.sum(1, keepdims=True)), nan=NEVER, neginf=NEVER), NEVER)
        self.params = params.astype(np.float32)
        self.square = np.zeros_like(self.params)
        self.step = np.zeros_like(self.params)
        self.turn = 0
        self.held: dict[str, np.ndarray] = {}

    def parts(self, flat: np.ndarray) -> list[np.ndarray]:
        return [x.reshape(s) for x, s in zip(np.split(flat, self.cuts), self.shapes, strict=True)]

    def _room(self, name: str, *shape: int) -> np.ndarray:
        """An array that later calls use again: fresh ones cost more than what is reckoned in them."""
        n = int(np.prod(shape))
        if name not in self.held or len(self.held[name]) < n or self.held[name].dtype != self.params.dtype:
            self.held[name] = np.empty(n, self.params.dtype)
        return self.held[name][:n].reshape(shape)

    @staticmethod
    def _soft(logits: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Turns logits into their exponentials, shifted; gives the targets' shifted logits and the sums."""
        logits -= logits.max(1, keepdims=True)
        own = logits[np.arange(len(target)), target]
        np.exp(logits, out=logits)
        return own, logits @ np.ones(logits.shape[1], logits.dtype)

    def _forward(self, context: np.ndarray, leaf: np.ndarray):
        """Hidden layer, exponentials and sums of both levels, and log-probabilities; all in an order by class, which is given with each class's begin."""
        table, bias, out, top, out2, top2 = self.parts(self.params)
        order = np.argsort(leaf, kind="stable")
        cls, sub = np.divmod(leaf[order], SUBS)
        start, n = np.searchsorted(cls, np.arange(CLASSES + 1)).tolist(), len(leaf)
        hidden, more = self._room("hidden", n, HIDDEN), self._room("more", n, HIDDEN)
        hidden[:] = bias
        for i, c in enumerate(context):
            hidden += np.take(table[i], c[order], axis=0, out=more, mode="clip")
        np.tanh(hidden, out=hidden)
        one, two = np.matmul(hidden, out, out=self._room("one", n, CLASSES)), self._room("two", n, SUBS)
        one += top
        for c, (a, z) in enumerate(zip(start, start[1:])):  # noqa: B905
            if a < z:
                np.matmul(hidden[a:z], out2[c], out=two[a:z])
                two[a:z] += top2[c]
        (own1, sum1), (own2, sum2) = self._soft(one, cls), self._soft(two, sub)
        return order, start, cls, sub, hidden, one, sum1, two, sum2, own1 - np.log(sum1) + own2 - np.log(sum2)

    def log_probs(self, context: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """log p(class | sides) + log p(leaf | class, sides)."""
        found = np.empty(len(leaf))
        order, *_, each = self._forward(context, leaf)
        found[order] = each
        return found

    def gradient(self, context: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """Of the mean of -log_probs, by the parameters."""
        grad, n = np.zeros_like(self.params), len(leaf)
        table_, bias_, out_, top_, out2_, top2_ = self.parts(grad)
        _, _, out, _, out2, _ = self.parts(self.params)
        order, start, cls, sub, hidden, one, sum1, two, sum2, _ = self._forward(context, leaf)
        for e, whole, target in ((one, sum1, cls), (two, sum2, sub)):
            e /= whole[:, None]
            e[np.arange(n), target] -= 1
        out_[:], top_[:] = hidden.T @ one, one.sum(0)
        back, more = np.matmul(one, out.T, out=self._room("back", n, HIDDEN)), self._room("more", n, HIDDEN)
        for c, (a, z) in enumerate(zip(start, start[1:])):  # noqa: B905
            if a < z:
                out2_[c], top2_[c] = hidden[a:z].T @ two[a:z], two[a:z].sum(0)
                back[a:z] += np.matmul(two[a:z], out2[c].T, out=more[a:z])
        np.multiply(hidden, hidden, out=more)
        np.subtract(1, more, out=more)
        back *= more
        bias_[:] = back.sum(0)
        for i, c in enumerate(context):
            own = c[order].astype(np.uint8)
            by = np.argsort(own, kind="stable")
            seen, first = np.unique(own[by], return_index=True)
            table_[i][seen] = np.add.reduceat(np.take(back, by, axis=0, out=more, mode="clip"), first)
        grad /= n
        return grad

    def train(self, context: np.ndarray, leaf: np.ndarray) -> None:
        """One step of Adam."""
        grad = self.gradient(context, leaf)
        self.turn += 1
        self.step *= 0.9
        self.step += 0.1 * grad
        self.square *= 0.99
        grad *= grad
        grad *= 0.01
        self.square += grad
        np.sqrt(self.square, out=grad)
        grad += 1e-8
        np.divide(self.step, grad, out=grad)
        grad *= RATE * np.sqrt(1 - 0.99**self.turn) / (1 - 0.9**self.turn)
        self.params -= grad


class Reader:
    """Words of many texts in one array, WINDOW edges between them."""

    def __init__(self):
        self.words = Words()

    def tokens(self, text: str) -> np.ndarray:
        return self.words(text.encode())[2].view(np.int64)

    @staticmethod
    def line(found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Leaves with edges (a leaf of class CLASSES), and where the words stand in them."""
        edge = np.full(WINDOW, CLASSES * SUBS, np.int64)
        line = np.concatenate([edge, *(x for t in found for x in (t, edge))])
        return line, np.flatnonzero(line < CLASSES * SUBS)

    @staticmethod
    def around(line: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Classes beside each place."""
        return np.stack([line[at + d] for d in range(-WINDOW, WINDOW + 1) if d]) // SUBS


def narrow(place: np.ndarray) -> bytes:
    """Whole numbers in three bytes each, or four where one needs them."""
    wide = place.astype("<u4").view(np.uint8).reshape(-1, 4)
    return (wide if len(place) and place.max() >> 24 else wide[:, :3]).tobytes()


def widened(data: bytes, n: int) -> np.ndarray:
    """The n numbers of narrow()."""
    out = np.zeros((n, 4), np.uint8)
    if n:
        width = len(data) // n
        out[:, :width] = np.frombuffer(data, np.uint8).reshape(n, width)
    return out.view("<u4").ravel()


def blocks(rows: DataFrame) -> DataFrame:
    """(block, ids, sizes, places, words, counts) from rows (id, text): distinct words, and each word's place among them."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, number, ids, found, n = Reader(), TaskContext.get().partitionId() << 32, [], [], 0

        def block() -> pa.RecordBatch:
            words, place, counts = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
            sizes = pa.array([[len(t) for t in found]], pa.list_(pa.int32()))
            lists = [pa.array([x], pa.list_(pa.int64())) for x in (words, counts)]
            own = pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), pa.concat_arrays(ids))
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), own, sizes, pa.array([narrow(place)], pa.binary()), *lists], ["block", "ids", "sizes", "places", "words", "counts"])

        for b in small_batches(batches):
            new = [reader.tokens(t) for t in texts(b, "text")]
            ids.append(b.column(0))
            found += new
            n += sum(map(len, new))
            if n >= BLOCK:
                yield block()
                number, ids, found, n = number + 1, [], [], 0
        if found:
            yield block()

    return rows.mapInArrow(run, f"block long, ids array<{kind}>, sizes array<int>, places binary, words array<long>, counts array<long>")


def vocabulary_of(held: DataFrame) -> Vocabulary:
    """From all blocks' words."""
    each = held.select(F.explode(F.arrays_zip("words", "counts")).alias("w")).select("w.words", "w.counts")
    return Vocabulary(materialize(each.groupBy(F.col("words").alias("word")).agg(F.sum("counts").alias("n"))))


def laid_out(held: DataFrame, vocabulary: Vocabulary, own: bool) -> DataFrame:
    """(id, n, leaves, share, novel, h) of each document: two bytes for each word, and the sum of log p(word | leaf). own: the vocabulary counts these documents."""
    each = held.select("block", F.posexplode("words").alias("i", "word")).join(vocabulary.table, "word", "left")
    count = F.coalesce("n", F.lit(0)) * SLICES + F.col("word").bitwiseAND(SLICES - 1)  # all that a word's cell needs
    known = each.groupBy("block").agg(F.collect_list("i").alias("i"), F.collect_list(count).alias("n"))
    both = held.select("block", "ids", "sizes", "places").join(known, "block", "left").select("ids", "sizes", "places", "i", "n", "block")
    sent = held.sparkSession.sparkContext.broadcast(vocabulary.cells)
    kind = held.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in (batch.slice(x, 1) for x in range(batch.num_rows)):
                sizes, i, n = (b.column(x).flatten().to_numpy() for x in (1, 3, 4))
                place = widened(b.column(2)[0].as_py(), int(sizes.sum()))
                words, n = np.divmod(n[np.argsort(i)], SLICES)[::-1]
                leaf, share = sent.value(words, n, own)
                doc = np.repeat(np.arange(len(sizes)), sizes)
                total = np.bincount(doc, weights=share[place], minlength=len(sizes))
                novel = np.bincount(doc[n[place] <= own], minlength=len(sizes))
                leaf, cuts = leaf[place].astype("<u2"), np.concatenate(([0], np.cumsum(sizes)))
                rows = [leaf[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0).flatten(), pa.array(sizes, pa.int64()), pa.array(rows, pa.binary()), pa.array(total, pa.float64()), pa.array(novel, pa.int64())], ["id", "n", "leaves", "share", "novel"])

    found = both.sortWithinPartitions("block").mapInArrow(run, f"id {kind}, n long, leaves binary, share double, novel long")
    return materialize(found.withColumn("h", F.xxhash64(F.col("id").cast("string"), "leaves")))


def lines(batch: pa.RecordBatch, at: int) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u2").astype(np.int64) for x in batch.column(at).to_pylist()]


def train(laid: DataFrame, cells: Cells, rounds: int = ROUNDS) -> Network:
    """Network from all documents of laid_out()."""
    sc, network = laid.sparkSession.sparkContext, Network(mass=cells.total)
    shards = max(1, int(np.ceil(np.sqrt(cells.tokens / SHARD))))
    rows = laid.where("n > 0").select(F.pmod("h", F.lit(shards)).cast("int").alias("shard"), F.pmod(F.shiftright("h", 32), F.lit(rounds)).cast("int").alias("part"), "h", "leaves")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, n = None, 0
        for b in batches:
            for value, k in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                value = np.frombuffer(value, "<i8")
                whole, n = (value.copy() if whole is None else whole + value), n + k
        if whole is not None:
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([whole.astype("<i8").tobytes()], pa.binary()), pa.array([n], pa.int64())], ["at", "value", "n"])

    for part in range(rounds):
        sent = sc.broadcast(network.params)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            held, size, shard, n, own = [], 0, None, 0, None

            def learn() -> None:
                line, at = Reader.line(held)
                steps = -(-len(at) // BATCH)
                for i in range(steps):
                    some = at[i::steps]  # from all of these documents
                    own.train(Reader.around(line, some), line[some])

            def done() -> pa.RecordBatch:
                fixed = np.rint(own.params.astype(np.float64) * FIXED).astype(np.int64) * n
                return pa.RecordBatch.from_arrays([pa.array([shard % GROUPS], pa.int32()), pa.array([fixed.astype("<i8").tobytes()], pa.binary()), pa.array([n], pa.int64())], ["at", "value", "n"])

            for b in batches:
                for s, leaves in zip(b.column(0).to_pylist(), lines(b, 1), strict=True):
                    if s != shard or size >= 16 * BATCH:
                        if held:
                            learn()
                        if s != shard:
                            if shard is not None:
                                yield done()
                            shard, n, own = s, 0, Network(sent.value)
                        held, size = [], 0
                    held.append(leaves)
                    size += len(leaves)
                    n += len(leaves)
            if held:
                learn()
                yield done()

        dealt = rows.where(F.col("part") == part).repartitionByRange(shards, "shard").sortWithinPartitions("shard", "h", "leaves").select("shard", "leaves")
        sums = dealt.mapInArrow(run, "at int, value binary, n long").repartition(GROUPS, "at").mapInArrow(add, "at int, value binary, n long").collect()
        weight = sum(r.n for r in sums)
        if weight:
            network = Network(sum(np.frombuffer(r.value, "<i8").astype(object) for r in sums).astype(np.float64) / weight / FIXED)
        sent.destroy()
    return network


def fit(rows: DataFrame, rounds: int = ROUNDS) -> tuple[Vocabulary, Network]:
    """Vocabulary and network from all rows' texts."""
    held = materialize(blocks(rows.select(F.lit(0).alias("id"), "text")))
    vocabulary = vocabulary_of(held)
    return vocabulary, train(laid_out(held, vocabulary, True), vocabulary.cells, rounds)


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: tuple[Vocabulary, Network] | None = None) -> DataFrame:
    """(id_col, n_tokens, log_prob, mean_log_prob, n_novel) of each row, by a model fitted to docs unless one is given."""
    held = materialize(blocks(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))))
    vocabulary = model[0] if model else vocabulary_of(held)
    laid = laid_out(held, vocabulary, model is None)
    release(held)
    network = model[1] if model else train(laid, vocabulary.cells)
    sent = docs.sparkSession.sparkContext.broadcast(network.params)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network(sent.value)
        for b in small_batches(batches):
            sizes = b.column(1).to_numpy()
            line, at = Reader.line(lines(b, 2))
            each = np.zeros(len(at))
            for i in range(0, len(at), BATCH):
                some = at[i : i + BATCH]
                each[i : i + BATCH] = own.log_probs(Reader.around(line, some), line[some])
            total = np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=each, minlength=len(sizes))
            total = (total + b.column(3).to_numpy()).round(4)
            mean = [round(t / n, 6) if n else None for t, n in zip(total.tolist(), sizes.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(total, pa.float64()), pa.array(mean, pa.float64()), b.column(4)], ["id", "n_tokens", "log_prob", "mean_log_prob", "n_novel"])

    kind = docs.schema[id_col].dataType.simpleString()
    return laid.select("id", "n", "leaves", "share", "novel").mapInArrow(run, f"id {kind}, n_tokens long, log_prob double, mean_log_prob double, n_novel long").withColumnRenamed("id", id_col)
