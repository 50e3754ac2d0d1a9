"""Language identification by compression.

A language's dictionary is raw text of that language. A text is cut into pieces, every piece is compressed by zstandard
with each language's dictionary, and the language with the smallest total is chosen. The score is the share of the second
smallest total that the choice saves; texts whose score is below MARGIN are rejected.

Matches may be as short as three bytes, since most words of a language are short.

Dictionaries come from a bounded sample: for each language the SAMPLE labelled documents whose ids' hashes are smallest,
and DICTIONARY bytes of their texts in all. Only rows whose hash is below SPARE times the expected bound are ranked, so what
is ranked doesn't grow with the input. Everything else reads whole texts.

Null texts and texts without a letter are `und`, with score 0, and rejected. So are all texts where nothing was learned.
Ties go to the language that is first by code point. Rows are independent of each other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from ._shared import free, small_batches

SAMPLE, SPARE, DICTIONARY, PIECE, SHORTEST, MARGIN = 256, 4, 1 << 17, 1 << 12, 3, 0.01
#: Per byte: A-Z in lower case; all else of ASCII that is no letter becomes a space.
PLAIN = bytes(x + 32 if 65 <= x <= 90 else x if x >= 128 or 97 <= x <= 122 else 32 for x in range(256))
LETTER = re.compile(r"[^\W\d_]")


def plain(text: str) -> bytes:
    """What is compressed: lower case, words and single spaces."""
    return b" ".join(text.lower().encode().translate(PLAIN).split())


def held_out(id_: Column) -> Column:
    return F.crc32(id_.cast("string").cast("binary")) % 4 == 2


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, size: int = DICTIONARY) -> dict[str, bytes]:
    """Raw dictionaries by language, from `sample` documents a language at most. docs has the rows that may be learned from."""
    named = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL AND id IS NOT NULL")
    rows = named.withColumn("h", F.xxhash64("id"))
    count = F.broadcast(rows.groupBy("lang").agg(F.count("*").alias("n")))  # a row a language
    below = (F.col("h").cast("double") + 2.0**63) * F.col("n") <= SPARE * sample * 2.0**64
    near = rows.join(count, "lang").where(below).select("id", "lang", "h", F.substring("text", 1, 4 * size // sample).alias("text"))
    place = F.row_number().over(W.partitionBy("lang").orderBy("h", "id", "text"))
    by: dict[str, dict] = {}
    for r in near.withColumn("place", place).where(F.col("place") <= sample).collect():
        by.setdefault(r.lang, {}).setdefault(r.id, plain(r.text))
    return {lang: b" ".join(t[: size // len(got) - 1] for _, t in sorted(got.items()))[:size] for lang, got in sorted(by.items())}


class Classifier:
    """Sizes under each dictionary; made once a task."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = sorted(dictionaries)
        self.by = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            how = zstandard.ZstdCompressionParameters.from_level(3, source_size=PIECE, dict_size=len(dictionaries[lang]), min_match=SHORTEST, strategy=zstandard.STRATEGY_GREEDY, write_content_size=0, write_checksum=0, write_dict_id=0)
            d.precompute_compress(compression_params=how)
            self.by.append(zstandard.ZstdCompressor(dict_data=d, compression_params=how))

    def sizes(self, data: bytes) -> list[int]:
        pieces = [data[at : at + PIECE] for at in range(0, len(data), PIECE)]
        return [sum(len(c.compress(p)) for p in pieces) for c in self.by]

    def __call__(self, text: str | None) -> tuple[str, float]:
        if not text or not self.by or not LETTER.search(text):
            return "und", 0.0
        sizes = self.sizes(plain(text))
        best = min(range(len(sizes)), key=lambda i: (sizes[i], i))
        rest = [x for i, x in enumerate(sizes) if i != best]
        return self.langs[best], (min(rest) - sizes[best]) / min(rest) if rest else 1.0


def rejected(lang: str, score: float, margin: float) -> bool:
    return lang == "und" or score < margin


def predict(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """docs with lang_pred, score and lang_rejected added; no shuffle. Columns of docs stay: where it has one of these names, the added one gets an underscore after it."""
    own = [free(x, docs.columns) for x in ("lang_pred", "score", "lang_rejected")]
    sent = docs.sparkSession.sparkContext.broadcast(dictionaries)  # languages times DICTIONARY bytes
    names = [*docs.columns, *own]
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(sent.value)
        for b in small_batches(batches):
            found = [classify(t) for t in b.column(at).to_pylist()]
            kinds = (pa.string(), pa.float64(), pa.bool_())
            cols = zip(*((x, round(s, 6), rejected(x, s, margin)) for x, s in found), strict=True) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names)

    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, k) for n, k in zip(own, (T.StringType(), T.DoubleType(), T.BooleanType()), strict=True))])
    return docs.mapInArrow(run, schema)


def keep_sure(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """The rows of docs that predict() doesn't reject, with docs's columns as they are; no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(dictionaries)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(sent.value)
        for b in small_batches(batches):
            yield b.filter(pa.array([not rejected(*classify(t), margin) for t in b.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
