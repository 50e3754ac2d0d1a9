"""Secret scans with corpus-wide ownership frequency.

Candidates are the base spans (assign, access, hex) and the matches of further token formats that overlap none of them.
Each candidate's secret part (of a private key its body, of a header without a body the header) is hashed, and all documents
of the corpus are asked how many distinct repositories and owners hold that hash. What WIDE or more owners hold is a widely
copied example; what fewer hold looks like somebody's own, however many of their repositories hold it. A repository without
an owner is its own owner. Base spans stay whatever the answer; further formats are added where they look like somebody's own.

The counts are taken in three steps (repository, owner, hash), so a hash that a third of all documents hold is spread over
its repositories and owners before it meets in one row; the join back to the spans has an exchange of its own on each side,
which adaptive execution splits where one hash is hot. Everything is DataFrame expressions.

Null texts are empty. Null repositories are one repository. Rows that share an id, and repeated rows, are separate. Spans that
begin together stand in the kinds' order. A table without rows gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import apart, hex_sha256, materialize
from ._spans import in_order, let, of_kind, overlap, spans, told, unmarked

WIDE = 3
BASE = ("assign", "access", "hex")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}+"
#: Formats of widely used services' tokens, private key headers, signed web tokens, and passwords in addresses.
FURTHER = {
    "github": r"gh[pousr]_[A-Za-z0-9]{20,}",
    "slack": r"xox[abprs]-[A-Za-z0-9-]{10,}",
    "jwt": r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+",
    "pem": r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----(?:[A-Za-z0-9+/=\s]*+-----END [A-Z ]{0,24}PRIVATE KEY-----)?",
    "login": r"[a-z][a-z0-9+.-]{1,15}://[^\s/:@]{1,64}:[^\s/:@]{1,64}@",
}


def base(text: Column) -> Column:
    """The spans of the three plain kinds in an unmarked text, each of whose value is the secret part."""
    part = lambda s: F.regexp_extract(s["value"], ASSIGN, 2)
    named = lambda s: let(part(s), lambda v: F.struct(s["start"], s["rank"], s["end"], s["kind"], v.alias("value")))
    assign = F.filter(F.transform(spans(text, ASSIGN, "assign", 0), named), lambda s: F.length(s["value"]) >= 6)
    return F.concat(assign, spans(text, ACCESS, "access", 1, F.contains(text, F.lit("AKIA"))), spans(text, HEX, "hex", 2))


def candidates(text: Column) -> Column:
    """All spans of a text, (start, rank, end, kind, value, base)."""
    names = list(FURTHER)

    def further(t: Column) -> Column:
        found = [spans(t, FURTHER[k], k, len(BASE) + i, F.contains(t, F.lit({"github": "gh", "slack": "xox", "jwt": "eyJ", "pem": "-----BEGIN ", "login": "://"}[k]))) for i, k in enumerate(names)]
        return F.concat(*found)

    def both(t: Column) -> Column:
        marked = lambda s, b: F.struct(s["start"], s["rank"], s["end"], s["kind"], s["value"], F.lit(b).alias("base"))

        def add(own: Column) -> Column:
            rest = F.filter(further(t), lambda s: ~F.exists(own, lambda b: overlap(s, b)))
            return F.concat(F.transform(own, lambda s: marked(s, True)), F.transform(rest, lambda s: marked(s, False)))

        return in_order(let(base(t), add))

    return let(unmarked(text), both)


def secret_part(span: Column) -> Column:
    """What is hashed: a private key's body without white space, any other span's value."""
    body = F.regexp_replace(span["value"], r"-----[A-Z ]+-----|\s", "")
    return F.when((span["kind"] == "pem") & (body != ""), body).otherwise(span["value"])


def ownership(found: DataFrame) -> DataFrame:
    """(hash, repositories, owners) of every candidate hash in rows (hash, repository, owner)."""
    by_repository = found.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    by_owner = by_repository.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    return by_owner.groupBy("hash").agg(F.sum("n").alias("repositories"), F.count("*").alias("owners"))


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repository_col: str = "doc_id", owner_col: str = "source", wide: int = WIDE) -> DataFrame:
    """(id_col, spans): ordered array of (start, rank, end, kind, base, repositories, owners, own). One scan of the texts; only rows with candidates move.

    The documents table names no repository, so by default each document is one and its source is the owner.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(repository_col).alias("repository"), F.col(owner_col).alias("owner"), candidates(F.col(text_col)).alias("spans"))
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()))
    owner = F.coalesce(F.concat(F.lit("o:"), F.col("owner").cast("string")), F.concat(F.lit("r:"), F.col("repository").cast("string")))
    each = rows.select("row", "repository", owner.alias("owner"), F.explode("spans").alias("s")).withColumn("hash", F.md5(secret_part(F.col("s"))))
    counted = each.join(apart(ownership(each), "hash"), "hash").withColumn("own", F.col("owners") < wide)
    full = F.struct("s.start", "s.rank", "s.end", "s.kind", "s.base", "repositories", "owners", "own")
    back = counted.groupBy("row").agg(F.array_sort(F.collect_list(full)).alias("told"))
    none = F.array().cast(back.schema["told"].dataType)
    return rows.select("row", "id").join(back, "row", "left").select(F.col("id").alias(id_col), F.coalesce("told", none).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of the base spans, and all spans, from secrets(). n_own counts base spans that look like somebody's own, n_copied widely copied ones; most_owners and most_repositories are the largest counts of any span's hash."""
    own = F.filter("spans", lambda s: s["base"])
    stay = F.filter("spans", lambda s: s["base"] | s["own"])
    count = lambda c: F.size(F.filter("spans", c)).cast("long")
    return found.select(found.columns[0], *[of_kind(own, k).alias(f"n_{k}") for k in BASE], hex_sha256(told(own)).alias("base_sha256"), told(stay).alias("spans"), count(lambda s: s["base"] & s["own"]).alias("n_own"), count(lambda s: ~s["own"]).alias("n_copied"), *[F.coalesce(F.array_max(F.col("spans").getField(k)), F.lit(0)).cast("long").alias(f"most_{k}") for k in ("owners", "repositories")])
