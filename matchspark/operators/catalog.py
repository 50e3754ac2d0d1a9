"""Catalog rows: hygiene, canonical columns, and the two catalogs that the driver's part table stands for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import flags, size, text
from ..sources.tables import RAW
from . import matching

PRIVATE = ("brand 3", "brand 7", "brand 11")


def hygiene(df: DataFrame, key: str, ordinal: str, store: str) -> DataFrame:
    """Rows with a usable key, the first of each by the ordinal, marked with their store."""
    usable = df.na.drop(subset=[key]).where(~F.contains(F.col(key), F.lit("|")) | F.col(key).rlike("^[0-9]+$"))
    first = usable.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(ordinal))).where("_n = 1").drop("_n")
    return first.withColumn("store_id", F.lit(store))


def head(df: DataFrame, ordinal: str, n: int) -> DataFrame:
    return df.orderBy(ordinal).limit(n)


def nested(df: DataFrame, column: str, fields: list[str], prefix: str) -> DataFrame:
    """Fields of a JSON object as text columns; anything else gives nulls."""
    m = F.from_json(F.col(column), "map<string,string>")
    return df.withColumns({f"{prefix}_{f}": F.try_element_at(m, F.lit(f)) for f in fields})


def tag_list(c):
    """Tags of a JSON list, or the keys with a true value of a JSON object."""
    listed = F.from_json(c, "array<string>")
    keyed = F.map_keys(F.map_filter(F.from_json(c, "map<string,string>"), lambda k, v: ~F.lower(v).isin("false", "0", "", "null", "none")))
    return F.when(F.startswith(F.trim(c), F.lit("[")), listed).otherwise(keyed)


def raw_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part table as raw products: even keys are catalog A, odd ones B. Size texts take turns between four forms."""
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    turn = F.floor(F.col("p_partkey") / 2) % 4
    n = F.col("p_size").cast("string")
    sized = F.when(turn == 0, F.concat(n, F.lit(" oz"))).when(turn == 1, F.concat(n, F.lit(" ct"))).when(turn == 2, F.concat(F.lit("4 x "), n, F.lit(" fl oz"))).otherwise(F.concat(n, F.lit(".5 lb")))
    return p.select(
        F.col("p_partkey").cast("string").alias("item_id"), F.when(F.col("p_partkey") % 2 == 0, "A").otherwise("B").alias("store_id"), F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand_raw"), F.col("p_type").alias("info_category_0"), sized.alias("size_text"), F.col("p_retailprice").alias("price"),
    )


def described(rows: DataFrame) -> DataFrame:
    """Raw products with what is derived of those of their raw columns that there are."""
    if "name" in rows.columns:
        rows = rows.withColumn("name_norm", text.normalize(F.col("name")))
    if "brand_raw" in rows.columns:
        rows = rows.withColumn("brand_norm", text.normalize(F.col("brand_raw")))
        rows = rows.withColumn("brand", text.canonical_brand(F.col("brand_norm"), {"brand 1": "brand 2", "brand 4": "brand 5"}))
        rows = rows.withColumn("is_private_label", F.col("brand").isin(*PRIVATE))
    if "info_category_0" in rows.columns:
        rows = rows.withColumn("category_norm", text.normalize(F.col("info_category_0")))
        rows = rows.withColumn("food_like", flags.food_like(text.tokens(F.col("category_norm"))))
    return rows.withColumn("size", size.parse_size(F.col("size_text"))).select("*", "size.*").drop("size")


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_parts() as canonical products."""
    return described(raw_parts(spark, sf_dir))


#: The raw columns that derived ones come from, where not the size text.
ORIGIN = {"name_norm": "name", "brand_norm": "brand_raw", "brand": "brand_raw", "is_private_label": "brand_raw", "category_norm": "info_category_0", "food_like": "info_category_0"}


def kinds(spark: SparkSession, sf_dir: str, *columns: str, ids: bool = False) -> tuple[DataFrame, DataFrame]:
    """sides() with a row for all products of one raw form: how many they are, n_a or n_b, and with `ids` the first id, in place of ids.

    Texts are parsed once a form. The raw columns come out of first(), or filters on what is derived of them would be
    pushed below the aggregation and parse every row. first() or min() of a text sorts what it reads, so it reads forms: rows
    are counted before, by hash. Ids of one length and sign are in order as numbers, negative ones backwards.
    """
    raw = raw_parts(spark, sf_dir)
    by = sorted({c if c in raw.columns else ORIGIN.get(c, "size_text") for c in columns} | {"size_text"})
    key, number = ["store_id", *[f"_{c}" for c in by]], F.col("item_id").cast("long")
    alike = [F.length("item_id").alias("_length"), (number < 0).alias("_below")] if ids else []
    ends = [F.min(number).alias("_low"), F.max(number).alias("_high")] if ids else []
    first = [F.min(F.least(F.col("_low").cast("string"), F.col("_high").cast("string"))).alias("item_id")] if ids else []
    forms = raw.groupBy("store_id", *[F.col(c).alias(f"_{c}") for c in by], *alike).agg(F.count("*").alias("n"), *ends)
    forms = forms.groupBy(*key).agg(*first, F.sum("n").alias("n"), *[F.first(f"_{c}").alias(c) for c in by])
    rows = described(forms)
    return tuple(rows.where(F.col("store_id") == s).select(*[F.col(c).alias(f"{c}_{s.lower()}") for c in (*["item_id"] * ids, "n", *columns)]) for s in "AB")


def sides(spark: SparkSession, sf_dir: str, *columns: str) -> tuple[DataFrame, DataFrame]:
    """Catalogs A and B with columns suffixed _a and _b."""
    rows = parts(spark, sf_dir)
    return tuple(rows.where(F.col("store_id") == s).select(*[F.col(c).alias(f"{c}_{s.lower()}") for c in ("item_id", *columns)]) for s in "AB")


def tiled(spark: SparkSession, sf_dir: str, *levels: tuple[str, dict]) -> tuple[DataFrame, DataFrame]:
    """sides() as matching.tiles() of one raw brand and size, with what is derived of these; texts are parsed once a tile."""
    raw = raw_parts(spark, sf_dir)
    both = [described(matching.tiles(raw.where(F.col("store_id") == s), ["brand_raw", "size_text"], *levels)) for s in "AB"]
    return tuple(d.toDF(*[f"{c}_{s}" for c in d.columns]) for d, s in zip(both, "ab", strict=True))


#: Fields of the JSON columns.
INFO = ("category_0", "category_1", "category_2", "category_3", "storage_type", "packaging_description", "ingredients", "planogram")
SIZING = ("unit_price", "uom_unit_price", "billed_by_weight", "ordered_by_weight", "avg_size_per_piece", "size_user_friendly", "size_from_unit_price", "uom_billed_by_weight", "uom_ordered_by_weight", "num_servings_nutrition", "serving_size_nutrition", "serving_size_uom_nutrition")


def canonical(raw: DataFrame, store: str, ordinal: str = "ordinal") -> DataFrame:
    """The canonical products of a raw catalog (RAW's text columns, and an ordinal that says which row came first); absent columns are null."""
    lacking = [c for c in RAW if c not in raw.columns]
    rows = hygiene(raw.withColumns({c: F.lit(None).cast("string") for c in lacking}) if lacking else raw, "item_id", ordinal, store)
    rows = nested(nested(rows, "item_info", list(INFO), "info"), "sizing_comp", list(SIZING), "sizing")
    c = F.col
    levels = [c(f"info_category_{i}") for i in range(4)]
    name = text.first_present(c("name_clean"), c("name"))
    listed = F.coalesce(tag_list(c("tags")), F.array().cast("array<string>"))
    rows = rows.withColumns({
        "tags_list": listed, "tags_norm": F.array_join(F.array_sort(F.transform(listed, text.normalize)), " "), "name_clean_str": F.coalesce(name, F.lit("")), "name_norm": text.normalize(name),
        "brand_norm": text.normalize(c("brand_raw")), "url_slug_norm": text.normalize(F.replace(text.url_readable_slug(c("url")), F.lit("-"), F.lit(" "))), "category_path_norm": text.category_path(*levels),
        "description_norm": text.normalize(c("description")), "ingredients_norm": text.normalize(c("info_ingredients")),
        "size_text": F.coalesce(text.first_present(c("sizing_size_user_friendly"), c("size_raw"), c("name")), F.lit("")),
    })
    rows = rows.withColumns({"brand_canonical": text.canonical_brand(c("brand_norm")), "_size": size.parse_size(c("size_text"))}).select("*", "_size.*").drop("_size")
    names, tags, path = text.tokens(c("name_norm")), text.tokens(c("tags_norm")), text.tokens(c("category_path_norm"))
    rows = rows.withColumns({
        "is_private_label_inferred": flags.private_label(c("store_id"), c("brand_norm"), c("is_private_label"), c("tags_list")), "is_food_like": flags.food_like(path), "is_fresh_like": flags.fresh_like(path),
        "is_organic_inferred": flags.organic(names, tags, c("is_organic")),
        "retrieval_text": F.trim(F.concat_ws(" ", "name_norm", "brand_canonical", "url_slug_norm", "category_path_norm", F.substring("description_norm", 1, 200))),
    })
    return rows.withColumn("embedding_text", embedding_text())


def embedding_text() -> Column:
    """Labelled fields of a canonical product, missing ones left out; the flags always stand."""
    c = F.col
    part = lambda label, x: F.when(x != "", F.concat(F.lit(label), x))
    flag = lambda label, x: F.concat(F.lit(f"{label}="), F.when(x, "yes").otherwise("no"))
    said = F.concat(F.lit("flags: "), F.concat_ws(" ", flag("private_label", c("is_private_label_inferred")), flag("organic", c("is_organic_inferred")), flag("food", c("is_food_like")), flag("fresh", c("is_fresh_like"))))
    unit = F.when(c("dim") == "volume", "fl_oz").when(c("dim") == "weight", "oz").otherwise("count")
    return F.concat_ws(
        " | ", part("", text.present(F.trim(c("name")))), part("brand: ", c("brand_canonical")), part("size: ", c("size_text")), F.when(c("unit_value").isNotNull(), F.concat(F.lit("unit: "), text.number_text(c("unit_value")), F.lit(" "), unit)),
        F.when(c("pack_count") > 1, F.concat(F.lit("pack: "), c("pack_count").cast("string"))), part("category: ", c("category_path_norm")), part("url_slug: ", c("url_slug_norm")), said,
        part("ingredients: ", F.substring("ingredients_norm", 1, 300)), part("description: ", F.substring("description_norm", 1, 200)),
    )
