"""Package sizes: value, unit, pack count and the bucket that blocking uses, and relations between two sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import number_text

NUMBER = r"([0-9]*\.?[0-9]+)\s*"
#: Unit spellings in the order they are tried, their dimension, and the factor to fluid ounces or ounces.
UNITS = [
    (r"fl\.?\s*oz|fluid\s*ounces?|floz", "volume", 1.0),
    (r"l|liters?|litres?", "volume", 33.814),
    (r"ml|milliliters?|millilitres?", "volume", 0.033814),
    (r"oz|ounces?", "weight", 1.0),
    (r"lbs?|pounds?", "weight", 16.0),
    (r"kg|kilograms?", "weight", 35.274),
    (r"g|grams?", "weight", 0.035274),
    (r"ct|counts?|pieces?|pk|packs?", "count", 1.0),
]
PACK = r"([0-9]+)\s*(?:x|pk|pack|ct|count)\s*"


def bucket(dim: Column, value: Column) -> Column:
    """dim:value, coarser for larger values; half goes to even. A count of one is no key."""
    coarse = F.when((dim == "count") | (value >= 10), F.bround(value, 0)).when(value < 1, F.bround(value, 2)).otherwise(F.bround(value, 1))
    return F.when((dim == "count") & (value <= 1), "").when(dim.isNull() | value.isNull(), "").otherwise(F.concat(dim, F.lit(":"), number_text(coarse)))


def _let(value: Column, body) -> Column:
    """body(value), computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def parse_size(text: Column) -> Column:
    """A struct (dim, unit_value, total_value, pack_count, unit_bucket, total_bucket) of a size text. Multipacks first, then the first unit of the list that occurs anywhere."""

    def found(t: Column) -> Column:
        def unit(i: int, pack: bool) -> Column:
            spelled, dim, factor = UNITS[i]
            number = F.nullif(F.regexp_extract(t, (PACK if pack else "") + NUMBER + rf"(?:{spelled})\b", 2 if pack else 1), F.lit("")).cast("double")
            count = F.regexp_extract(t, PACK + NUMBER + rf"(?:{spelled})\b", 1).cast("double") if pack else F.lit(1.0)
            return _let(number, lambda v: F.when(v.isNotNull(), F.struct(F.lit(dim).alias("dim"), F.bround(v * factor, 4).alias("unit"), count.alias("packs"))))

        packs = F.when(t.rlike(PACK + NUMBER), F.coalesce(*[unit(i, True) for i, u in enumerate(UNITS) if u[1] != "count"]))
        return F.coalesce(packs, *[unit(i, False) for i in range(len(UNITS))])

    def whole(s: Column) -> Column:
        count = F.when(s["dim"] == "count", F.bround(s["unit"], 0)).otherwise(s["packs"])
        total = F.when(s["dim"] == "count", s["unit"]).otherwise(F.bround(s["unit"] * s["packs"], 4))
        return F.struct(s["dim"].alias("dim"), s["unit"].alias("unit_value"), total.alias("total_value"), count.cast("int").alias("pack_count"), bucket(s["dim"], s["unit"]).alias("unit_bucket"), bucket(s["dim"], total).alias("total_bucket"))

    return _let(_let(F.lower(F.coalesce(text, F.lit(""))), found), whole)


#: Unit spellings of the first parser and of its successor, in the order they are tried.
PLAIN_UNITS = [
    (r"fl\.?\s*oz|fluid\s*ounces?|floz", "fl_oz", "volume", 1.0),
    (r"l|liter|liters|litre|litres", "fl_oz", "volume", 33.814),
    (r"ml|milliliter|milliliters|millilitre|millilitres", "fl_oz", "volume", 0.033814),
    (r"oz|ounce|ounces", "oz", "weight", 1.0),
    (r"lb|lbs|pound|pounds", "oz", "weight", 16.0),
    (r"kg|kilogram|kilograms", "oz", "weight", 35.274),
    (r"g|gram|grams", "oz", "weight", 0.035274),
]
PLAIN_COUNT = (r"ct|count|counts|piece|pieces|pk|pack|packs", "count", "count", 1.0)
PROBE_PACKS = [r"^\s*\(?\s*(\d{1,3})\s*[- ]?(?:pack|pk)\s*\)?\b", r"\bpack\s+of\s+(\d{1,3})\b", r"\b(\d{1,3})\s*[- ]?(?:pack|pk)\b", r"\b(\d{1,3})\s*(?:ct|count)\s+(?:cans|bottles|bars|packets|pouches|bags|cups)\b"]


def plain_bucket(dim: Column, value: Column, trivial: bool = True) -> Column:
    """dim:value of the first parser; trivial: a count of one is a bucket too."""
    coarse = F.when((dim == "count") | (value >= 10), F.bround(value, 0)).when(value < 1, F.bround(value, 2)).otherwise(F.bround(value, 1))
    text = F.when(dim.isNull() | value.isNull(), "").otherwise(F.concat(dim, F.lit(":"), number_text(coarse)))
    return text if trivial else F.when((dim == "count") & (coarse <= 1), "").otherwise(text)


def _number(t: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(t, f"(?i){pattern}", 1), F.lit("")).cast("double")


def plain_size(text: Column) -> Column:
    """The first parser: a struct (size_value, size_unit, size_dimension, size_canonical, size_bucket). A pack count counts only right before the number."""

    def found(t: Column) -> Column:
        packs = F.coalesce(_number(t, r"(\d+)\s*(?:x|pk|pack)\s*\d+(?:\.\d+)?"), F.lit(1.0))

        def unit(spelled: str, name: str, dim: str, factor: float) -> Column:
            struct = lambda v: F.struct(v.alias("size_value"), F.lit(name).alias("size_unit"), F.lit(dim).alias("size_dimension"), F.bround(v * factor * packs, 4).alias("size_canonical"))
            return _let(_number(t, rf"(\d+(?:\.\d+)?)\s*(?:{spelled})\b"), lambda v: F.when(v.isNotNull(), struct(v)))

        return F.coalesce(*[unit(*u) for u in [*PLAIN_UNITS, PLAIN_COUNT]])

    whole = lambda s: F.struct(s["size_value"], s["size_unit"], s["size_dimension"], s["size_canonical"], plain_bucket(s["size_dimension"], s["size_canonical"]).alias("size_bucket"))
    return _let(_let(F.coalesce(text, F.lit("")), found), whole)


def pack_count(text: Column) -> Column:
    """The first pack phrase that names 2 to 100, wherever it stands; else 1."""
    return F.coalesce(*[_let(_number(text, x), lambda n: F.when((n > 1) & (n <= 100), n.cast("int"))) for x in PROBE_PACKS], F.lit(1))


def probe_size(text: Column) -> Column:
    """The successor: a struct (unit_dimension, unit_value, unit_bucket, total_bucket, pack_count, count_bucket). Reads leading decimals and detached pack counts; a count of one is no bucket."""

    def found(t: Column) -> Column:
        def unit(spelled: str, dim: str, factor: float, leading: bool) -> Column:
            number = r"(?<![\d.])(\d+(?:\.\d+)?|\.\d+)" if leading else r"(?<![\d.])(\d+(?:\.\d+)?)"
            return _let(_number(t, rf"{number}\s*(?:{spelled})\b"), lambda v: F.when(v.isNotNull(), F.struct(F.lit(dim).alias("dim"), (v * factor).alias("value"))))

        size = F.coalesce(*[unit(u[0], u[2], u[3], True) for u in PLAIN_UNITS], unit("ct|count|counts|each|piece|pieces", "count", 1.0, False))

        def whole(s: Column, packs: Column) -> Column:
            counted = s["dim"] == "count"
            value = plain_bucket(s["dim"], s["value"], False)
            total = F.when(counted, value).otherwise(plain_bucket(s["dim"], s["value"] * packs, False))
            return F.struct(
                F.coalesce(s["dim"], F.lit("")).alias("unit_dimension"), F.when(counted, s["value"]).otherwise(F.bround(s["value"], 4)).alias("unit_value"), value.alias("unit_bucket"),
                total.alias("total_bucket"), packs.alias("pack_count"), F.when(counted, value).otherwise("").alias("count_bucket"),
            )

        return _let(size, lambda s: _let(pack_count(t), lambda n: whole(s, n)))

    return _let(F.coalesce(text, F.lit("")), found)


def percent(part: Column, whole: Column) -> Column:
    """One decimal and a percent sign; 0.0% of nothing."""
    return F.when(whole > 0, F.format_string("%.1f%%", 100.0 * part / whole)).otherwise("0.0%")


def size_relation(dim_a: Column, a: Column, dim_b: Column, b: Column) -> Column:
    ratio = F.try_divide(a, b)
    whole = lambda r: F.abs(r - F.bround(r, 0)) < 0.10
    multiple = lambda r: whole(r) & F.bround(r, 0).between(2, 24)
    unknown = dim_a.isNull() | dim_b.isNull() | ratio.isNull() | (F.coalesce(a, F.lit(0.0)) == 0)
    return F.when(unknown, "unknown").when(dim_a != dim_b, "conflict_dim").when(ratio.between(0.92, 1.08), "same").when(ratio.between(0.85, 1.15), "near").when(multiple(ratio) | multiple(F.try_divide(b, a)), "multipack").otherwise("off")


def pack_relation(a: Column, b: Column) -> Column:
    return F.when(a.isNull() | b.isNull(), "unknown").when(a == b, "same").when((a == 1) | (b == 1), "multipack").otherwise("off")
