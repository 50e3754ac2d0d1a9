"""Hints, relations, vetoes, score and route of a record or a pair, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
PRIVATE_A = ("bettergoods", "equate", "freshness guaranteed", "great value", "marketside", "members mark", "member s mark", "mainstays", "ozark trail", "parent s choice", "parents choice", "sam s choice", "time and tru", "walmart")
PRIVATE_B = ("wegmans", "wegmans organic", "wegmans food you feel good about", "wegmans ez meals")
FOOD = ("food", "grocery", "dairy", "frozen", "produce", "beverages", "snacks", "pantry", "bakery", "meat", "seafood", "deli", "candy", "breakfast", "household essentials")
FRESH = ("produce", "meat", "seafood", "deli", "bakery", "prepared foods", "floral", "fresh")
FLAVOR = ("vanilla", "chocolate", "strawberry", "lemon", "lime", "orange", "apple", "grape", "cherry", "mango", "blueberry", "raspberry", "peach", "mint", "cinnamon", "caramel", "honey", "maple", "coconut", "pumpkin", "berry", "watermelon", "tropical")
FORM = ("ground", "whole bean", "instant", "k cup", "k cups", "pods", "liquid", "powder", "spray", "stick", "wipes", "lotion", "cream", "shampoo", "conditioner", "bar", "frozen", "fresh", "dried", "chips", "crackers", "cookies")
BRAND_POINTS = {"exact": 0.35, "alias": 0.30, "private_label_compatible": 0.18, "unknown": 0.05}
SIZE_POINTS = {"same": 0.30, "multipack": 0.22, "near": 0.18, "unknown": 0.06}


def hints(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def has_any(tokens: Column, words) -> Column:
    return F.arrays_overlap(tokens, hints(words))


def food_like(category_tokens: Column) -> Column:
    return has_any(category_tokens, FOOD)


def fresh_like(category_tokens: Column) -> Column:
    return has_any(category_tokens, FRESH)


def said_yes(c: Column) -> Column:
    """A text column that says true, 1 or yes."""
    return F.coalesce(F.lower(F.trim(c)).isin("true", "1", "yes"), F.lit(False))


def organic(name_tokens: Column, tag_tokens: Column, flag: Column) -> Column:
    return said_yes(flag) | F.array_contains(name_tokens, "organic") | F.coalesce(F.array_contains(tag_tokens, "organic"), F.lit(False))


def private_label(store: Column, brand: Column, flag: Column, tags: Column, a_brands=PRIVATE_A, b_brands=PRIVATE_B, b_tag: str = "wegmans_brand", b_prefix: str = "wegmans") -> Column:
    """Of a record of A by its flag or brand, of B by its tags or brand."""
    a = said_yes(flag) | brand.isin(*a_brands)
    tagged = F.exists(tags, lambda t: F.lower(t) == b_tag)
    return F.when(store == "A", a).otherwise(F.coalesce(tagged, F.lit(False)) | brand.isin(*b_brands) | F.startswith(brand, F.lit(b_prefix)))


def brand_relation(raw_a: Column, a: Column, pl_a: Column, raw_b: Column, b: Column, pl_b: Column) -> Column:
    """raw: normalised brands; a and b: canonical ones."""
    return F.when((raw_a == "") | (raw_b == ""), "unknown").when(raw_a == raw_b, "exact").when((a != "") & (a == b), "alias").when(pl_a & pl_b, "private_label_compatible").otherwise("conflict")


def hinted(tokens: Column, words) -> Column:
    return F.array_intersect(tokens, hints(words))


def hint_conflict(a: Column, b: Column, words) -> Column:
    """Both sides have hints, and none in common."""
    return hints_differ(hinted(a, words), hinted(b, words))


def hints_differ(x: Column, y: Column) -> Column:
    return (F.size(x) > 0) & (F.size(y) > 0) & ~F.arrays_overlap(x, y)


def organic_relation(a: Column, b: Column, food: Column) -> Column:
    return F.when(a == b, "match").when(food, "conflict").otherwise("soft_conflict")


def veto_reasons(brand: Column, unit: Column, flavor: Column, form: Column, organic: Column) -> Column:
    named = [(brand == "conflict", "brand_conflict"), (unit == "conflict_dim", "size_dim_conflict"), (flavor, "flavor_conflict"), (form, "form_conflict"), (organic == "conflict", "organic_conflict")]
    return F.concat_ws(",", *[F.when(c, n) for c, n in named])


def points(c: Column, table: dict[str, float]) -> Column:
    out = F.lit(0.0)
    for k, v in table.items():
        out = F.when(c == k, v).otherwise(out)
    return out


#: The most that categories give, and more than rounding to three places moves a score.
CATEGORY_POINTS, ROUNDED = 0.05, 0.001


def whole_score(brand: Column, unit: Column, total: Column, fuzzy: Column, cosine: Column, categories: Column) -> Column:
    size = F.when(total == "same", F.greatest(points(unit, SIZE_POINTS), F.lit(0.22))).otherwise(points(unit, SIZE_POINTS))
    return points(brand, BRAND_POINTS) + size + 0.18 * fuzzy / 100 + 0.12 * F.greatest(F.lit(0.0), F.least(F.coalesce(cosine, F.lit(0.0)), F.lit(1.0))) + CATEGORY_POINTS * categories


def final_score(brand: Column, unit: Column, total: Column, fuzzy: Column, cosine: Column, categories: Column, vetoes: Column) -> Column:
    return F.when(vetoes != "", 0.0).otherwise(F.bround(whole_score(brand, unit, total, fuzzy, cosine, categories), 4))


def route(brand: Column, unit: Column, fuzzy: Column, cosine: Column, vetoes: Column, source: Column) -> Column:
    known = brand.isin("exact", "alias")
    sized = unit.isin("same", "multipack") & known & (fuzzy >= 92)
    close = (F.coalesce(cosine, F.lit(0.0)) >= 0.6) & known & unit.isin("same", "near", "multipack")
    noise = (source == "T3") & (F.coalesce(cosine, F.lit(0.0)) < 0.45) & ~brand.isin("exact", "alias", "private_label_compatible") & ~unit.isin("same", "near", "multipack")
    return F.when(vetoes != "", "drop").when(sized | close, "auto_accept").when(noise, "drop").otherwise("route_to_llm")
