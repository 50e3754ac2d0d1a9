"""Text normalisation as column expressions. Empty text, not null, marks a missing normalised value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Brands that are written in more than one way, after normalisation.
BRAND_ALIASES = {
    "e l f cosmetics": "e l f", "l oreal paris": "l oreal", "amy s kitchen": "amy s", "nature s path organic": "nature s path",
    "bigelow tea": "bigelow", "so delicious dairy free": "so delicious", "bush s best": "bush s", "stonyfield organic": "stonyfield",
    "nestl toll house": "toll house", "lindt lindor": "lindt", "hero cosmetics": "hero", "u by kotex": "kotex", "mars wrigley": "mars",
    "rachael ray nutrish": "nutrish", "clif bar": "clif", "coors light": "coors", "voortman bakery": "voortman",
    "mt olive pickle": "mt olive", "suave essentials": "suave", "c4 energy": "c4",
}
#: Words of store brands that names are compared without, in the order they are taken out.
PRIVATE_TERMS = ("great value", "marketside", "bettergoods", "equate", "sam s choice", "walmart", "wegmans", "wegmans organic", "wegmans brand")
#: Shapes that size parsers stumble on.
MULTIPACK = r"(?i)\(?\s*[0-9]+\s*(?:pack|pk|count|ct|x)\s*\)?|[0-9]+\s*[- ]?(?:pack|pk)\b"
LEADING_DECIMAL = r"(?i)(?<![0-9])\.[0-9]+\s*(?:l|liter|litre|ml|kg|g|oz)\b"
TRIVIAL_COUNT = r"(?i)^\s*1\s*(?:ct|count|each|pc|piece|pk|pack)\s*$"
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl"}


def is_missing(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c, F.lit("")))).isin("", "nan", "none", "null")


def present(c: Column) -> Column:
    """The value, or null where it is missing."""
    return F.when(~is_missing(c), c)


def first_present(*cs: Column) -> Column:
    return F.coalesce(*[present(c) for c in cs])


def normalize(c: Column) -> Column:
    spelled = F.replace(F.lower(F.when(is_missing(c), F.lit("")).otherwise(c)), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(spelled, "[^a-z0-9]+", " "))


def tokens(c: Column, longer_than: int = 0) -> Column:
    """Distinct words of a normalised text."""
    return F.array_distinct(F.filter(F.split(c, " "), lambda x: F.length(x) > longer_than))


def jaccard(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))), F.lit(0.0))


def canonical_brand(normalised: Column, aliases: dict[str, str] | None = None) -> Column:
    table = F.create_map(*[F.lit(x) for pair in (aliases or BRAND_ALIASES).items() for x in pair])
    return F.coalesce(F.try_element_at(table, normalised), normalised)


def url_slug(url: Column) -> Column:
    """The last path segment, normalised."""
    return normalize(F.regexp_extract(F.rtrim(url, F.lit("/")), r"(?i)/([a-z0-9][a-z0-9_-]+)$", 1))


def url_segments_slug(url: Column) -> Column:
    """Path segments but for shop words and bare numbers, each without a leading number, joined by hyphens."""
    path = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z]+://[^/?#]*([^?#]*)", 1)
    kept = F.filter(F.split(path, "/"), lambda x: (x != "") & ~F.lower(x).isin("ip", "shop", "product") & ~x.rlike("^[0-9]+$"))
    return F.lower(F.array_join(F.transform(kept, lambda x: F.regexp_replace(x, "^[0-9]+[-_]", "")), "-"))


def url_readable_slug(url: Column) -> Column:
    """Path segments but for shop words, each without a leading number, bare numbers left out, joined by hyphens; escapes decoded."""
    path = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z]+://[^/?#]*([^?#]*)", 1)
    kept = F.transform(F.filter(F.split(path, "/"), lambda x: (x != "") & ~x.isin("ip", "shop", "product")), lambda x: F.regexp_replace(x, "^[0-9]+[-_]", ""))
    slug = F.array_join(F.filter(kept, lambda x: (x != "") & ~x.rlike("^[0-9]+$")), "-")
    return F.coalesce(F.try_url_decode(F.replace(slug, F.lit("+"), F.lit("%2B"))), slug)


def codes(c: Column, low: int = 12, high: int = 14) -> Column:
    """Distinct runs of low to high digits that stand alone, without leading zeros."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(rf"\b([0-9]{{{low},{high}}})\b"), F.lit(1))
    stripped = F.transform(found, lambda x: F.regexp_replace(x, "^0+", ""))
    return F.array_distinct(F.transform(stripped, lambda x: F.when(x == "", "0").otherwise(x)))


def without_terms(c: Column, terms: list[str]) -> Column:
    """A normalised text without these substrings, taken out in order."""
    for t in terms:
        c = F.replace(c, F.lit(t), F.lit(" "))
    return F.trim(F.regexp_replace(c, " +", " "))


def category_path(*levels: Column) -> Column:
    """Normalised levels, missing ones left out, joined by a space."""
    return F.concat_ws(" ", *[F.nullif(normalize(c), F.lit("")) for c in levels])


def match_text(*columns: Column) -> Column:
    """Columns joined by a space, null as empty, normalised."""
    return normalize(F.concat_ws(" ", *columns))


def shape(c: Column, pattern: str) -> Column:
    """Whether a text that isn't missing has a shape such as MULTIPACK."""
    return ~is_missing(c) & c.rlike(pattern)


def parse_bool(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("true", "1", "yes"), F.lit(False))


def slug_tokens(slug: Column) -> Column:
    return tokens(normalize(F.replace(slug, F.lit("-"), F.lit(" "))), 1)


def clean_lines(c: Column) -> Column:
    """Ligatures spelled out, spaces and blank lines collapsed."""
    for k, v in LIGATURES.items():
        c = F.replace(c, F.lit(k), F.lit(v))
    return F.trim(F.regexp_replace(F.regexp_replace(c, "[ \t]+", " "), "\n{3,}", "\n\n"))


def number_text(c: Column) -> Column:
    """Up to two decimals, none for whole numbers."""
    return F.regexp_replace(F.bround(c, 2).cast("decimal(20,2)").cast("string"), r"\.?0+$", "")


def two_places(c: Column) -> Column:
    """Two decimals of what the binary number is, half to even, as C and Python print it; Java would round its shortest decimal, half up."""
    cents = F.floor(c * 100)
    high = c * 134217729.0 - (c * 134217729.0 - c)  # 26 bits, so both products below are exact
    over = (high * 200 - (2 * cents + 1)) + (c - high) * 200
    return F.format_string("%.2f", (cents + F.when((over > 0) | ((over == 0) & (cents % 2 == 1)), 1).otherwise(0)) / 100)
