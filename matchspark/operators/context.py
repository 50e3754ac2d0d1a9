"""Knowledge entries, their index and the context that a judge is given."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from . import knowledge, similarity
from .matching import private_label_top, strict_block_top, top

ENTRY = ("id", "type", "title", "content", "match_type", "tags", "source", "confidence")


def quoted(c: Column) -> Column:
    return F.concat(F.lit("'"), F.coalesce(c.cast("string"), F.lit("")), F.lit("'"))


def best_category(*levels: Column) -> Column:
    """The first level that is there; levels from deepest to widest."""
    return F.coalesce(*[text.present(F.trim(c)) for c in levels])


def wide_bridge(bridge: DataFrame, level: str) -> DataFrame:
    """category_bridge()'s rows as one row (a_level, a_category, support, b_top1, b_top1_share, ...) a category."""
    at = lambda i, c: F.max(F.when(F.col("rank") == i, F.col(c)))
    return bridge.groupBy("a_category").agg(F.max("support").alias("support"), *[x for i in (1, 2, 3) for x in (at(i, "b_category").alias(f"b_top{i}"), at(i, "share").alias(f"b_top{i}_share"))]).withColumn("a_level", F.lit(level))


def sure_targets(wide: DataFrame, support: int = 10, share: float = 0.0, levels: list[str] | None = None) -> DataFrame:
    """(a_category, b_category, share, support, rank) in lower case, of wide rows of enough support; share and levels narrow them."""
    rows = wide.where(F.col("support") >= support)
    rows = rows.where(F.col("a_level").isin(*levels)) if levels else rows
    each = rows.select(F.lower(F.trim("a_category")).alias("a_category"), "support", F.posexplode(F.array(*[F.struct(F.col(f"b_top{i}").alias("b"), F.col(f"b_top{i}_share").alias("s")) for i in (1, 2, 3)])).alias("i", "t"))
    return each.where(F.col("t.b").isNotNull() & (F.col("t.s") >= share)).select("a_category", F.lower(F.trim("t.b")).alias("b_category"), F.col("t.s").alias("share"), "support", (F.col("i") + 1).alias("rank"))


def bridge_hints(targets: DataFrame, k: int = 3) -> DataFrame:
    """(a_category, hint): the k first targets of a category as a line."""
    said = F.concat("b_category", F.lit(" (share="), text.two_places(F.col("share")), F.lit(")"))
    ordered = F.array_sort(F.collect_list(F.struct("rank", said.alias("t"))))
    return targets.where(F.col("rank") <= k).groupBy("a_category").agg(F.array_join(F.transform(ordered, lambda x: x["t"]), "; ").alias("hint"))


def alias_entries(candidates: DataFrame, least: float = 95) -> DataFrame:
    """Alias entries of (a_brand, b_brand, score) with canonical and variant in the id."""
    good = candidates.where((F.col("score") >= least) & (F.trim("a_brand") != "") & (F.trim("b_brand") != "") & ~F.col("a_brand").isin(*knowledge.DENIED) & ~F.col("b_brand").isin(*knowledge.DENIED))
    short = F.length("a_brand") <= F.length("b_brand")
    good = good.withColumns({"c": F.when(short, F.col("a_brand")).otherwise(F.col("b_brand")), "v": F.when(short, F.col("b_brand")).otherwise(F.col("a_brand"))})
    under = lambda c: F.replace(F.col(c), F.lit(" "), F.lit("_"))
    return entries(good, F.concat(F.lit("alias_"), under("c"), F.lit("_"), under("v")), "alias", F.concat(F.lit("Brand alias: "), quoted(F.col("v")), F.lit(" -> "), quoted(F.col("c"))), F.concat(F.lit("The brand "), quoted(F.col("v")), F.lit(" is another name of "), quoted(F.col("c")), F.lit(".")), F.col("score") / 100, tags=["alias"])


def bridge_entries(wide: DataFrame, support: int = 10, share: float = 0.4, k: int = 2) -> DataFrame:
    """An entry for each category whose first targets, k at most, have enough share."""
    good = top(sure_targets(wide, support, share), ["a_category"], ["rank"], k).drop("rank").withColumn("rank", F.lit(1))
    said = F.concat("b_category", F.lit(" (share="), text.two_places(F.col("share")), F.lit(")"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("share")).alias("s"), said.alias("t"))))
    rows = good.groupBy("a_category").agg(F.array_join(F.transform(ordered, lambda x: x["t"]), "; ").alias("t"), F.max("share").alias("confidence"))
    return entries(rows, F.concat(F.lit("bridge_"), F.replace("a_category", F.lit(" "), F.lit("_"))), "bridge", F.concat(F.lit("Category bridge: "), quoted(F.col("a_category"))), F.concat(F.lit("Category "), quoted(F.col("a_category")), F.lit(" of A maps to B's "), F.col("t")), F.col("confidence"), tags=["category_bridge"])


def example_entries(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Accepted and rejected examples of labelled pairs: pairs (pair_id, name_a, brand_a, size_a, category_a, ... _b), labels (pair_id, is_match, match_type, confidence, notes)."""
    rows = pairs.join(labels, "pair_id")
    side = lambda s: F.concat(F.lit(f"{s.upper()}: "), F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), quoted(F.col(f"{k}_{s}"))) for k in ("name", "brand", "size", "category")]))
    yes = text.parse_bool(F.col("is_match"))
    body = F.concat(side("a"), F.lit(". "), side("b"), F.lit(". Reason: "), F.coalesce("notes", F.lit("")))
    out = entries(rows, F.concat(F.when(yes, "acc_").otherwise("rej_"), F.col("pair_id")), F.when(yes, "accepted_example").otherwise("rejected_example"), F.when(yes, F.concat(F.lit("Accepted example ("), "match_type", F.lit(")"))).otherwise("Rejected example"), body, F.coalesce("confidence", F.lit(1.0)), F.when(yes, F.col("match_type")))
    return out.withColumn("tags", F.when(F.col("type") == "accepted_example", F.array(F.lit("example"), F.lit("positive"))).otherwise(F.array(F.lit("example"), F.lit("negative"))))


def example_snippets(pairs: DataFrame, labels: DataFrame, k: int = 25) -> DataFrame:
    """The first k accepted and k rejected pairs, by pair_id, as (id, title, content)."""
    yes = text.parse_bool(F.col("is_match"))
    rows = top(pairs.join(labels, "pair_id").withColumn("yes", yes), ["yes"], ["pair_id"], k)
    side = lambda s: F.concat(F.lit(f"{s.upper()}: "), F.coalesce(f"name_{s}", F.lit("")), F.lit(" / brand "), F.coalesce(f"brand_{s}", F.lit("")), F.lit(" / size "), F.coalesce(f"size_{s}", F.lit("")))
    return rows.select(F.concat(F.when(F.col("yes"), "acc_").otherwise("rej_"), F.col("pair_id")).alias("id"), F.when(F.col("yes"), "ACCEPTED example").otherwise("REJECTED example").alias("title"), F.concat(side("a"), F.lit(" | "), side("b"), F.lit(". Reason: "), F.coalesce("notes", F.lit(""))).alias("content"))


def entries(rows: DataFrame, id_: Column, type_, title: Column, content: Column, confidence: Column, match_type: Column | None = None, tags: list[str] | None = None, source: str = "derived") -> DataFrame:
    kind = F.lit(type_) if isinstance(type_, str) else type_
    return rows.select(id_.alias("id"), kind.alias("type"), title.alias("title"), content.alias("content"), (match_type if match_type is not None else F.lit(None).cast("string")).alias("match_type"), F.array(*[F.lit(t) for t in tags or []]).cast("array<string>").alias("tags"), F.lit(source).alias("source"), confidence.cast("double").alias("confidence"))


def bootstrap(*parts: DataFrame) -> DataFrame:
    """All knowledge entries in one table; of entries that share an id the one of highest confidence."""
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return top(every, ["id"], [F.desc("confidence"), "type", "title", "content"], 1).drop("rank")


def index(knowledge_: DataFrame, bank: DataFrame, embedder=knowledge.embed, model: str = "m", dim: int = 64, version: str = "v1") -> tuple[DataFrame, DataFrame]:
    """(entries with a vector, the bank grown): only texts that the bank lacks are embedded."""
    said = F.concat("title", F.lit(". "), F.col("content"))
    rows = knowledge_.select("id", knowledge.text_hash(said, model, dim, version).alias("hash"), said.alias("text"))
    vectors, grown = knowledge.embed_incrementally(rows, bank, embedder)
    return knowledge_.join(vectors.select("id", "vector"), "id"), grown


def tiny_search(queries: DataFrame, entries_: DataFrame, k: int = 3) -> DataFrame:
    """(id_a, id_b, score, rank): the k entries (id, text) most similar to each query (id, text) by TF-IDF of words, fitted on the entries, above 0."""
    weights = similarity.tfidf(entries_, 1, 1.0, chars=False)
    idf = entries_.select("id", F.explode(F.array_distinct(similarity.word_grams(F.col("text")))).alias("term")).groupBy("term").agg(F.count("*").alias("df")).join(F.broadcast(entries_.agg(F.count("*").alias("n"))))
    tf = queries.select("id", F.explode(similarity.word_grams(F.col("text"))).alias("term")).groupBy("id", "term").agg(F.count("*").alias("tf"))
    own = tf.join(idf, "term").select("id", "term", ((1 + F.log("tf")) * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1)).alias("w"))
    norm = own.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = own.join(norm, "id").select(F.col("id").alias("id_a"), "term", (F.col("w") / F.col("norm")).alias("wa")).join(weights.select(F.col("id").alias("id_b"), "term", "weight"), "term")
    near = dots.groupBy("id_a", "id_b").agg(F.round(F.sum(F.col("wa") * F.col("weight")), 6).alias("score")).where("score > 0")
    return top(near, ["id_a"], [F.desc("score"), "id_b"], k)


def query_text(scored: DataFrame) -> DataFrame:
    """(item_id_a, query) of rows (item_id_a, name_a, brand_a, size_a, name_b, brand_b, size_b, rank): what a search for context asks."""
    said = lambda c: F.coalesce(text.present(F.trim(F.col(c))), F.lit(""))
    one = F.concat(said("name_b"), F.lit(" ("), said("brand_b"), F.lit(", "), said("size_b"), F.lit(")"))
    listed = F.array_sort(F.collect_list(F.struct("rank", one.alias("t"))))
    rows = scored.groupBy("item_id_a").agg(F.first(said("name_a")).alias("n"), F.first(said("brand_a")).alias("b"), F.first(said("size_a")).alias("s"), F.array_join(F.transform(listed, lambda x: x["t"]), " | ").alias("t"))
    return rows.select("item_id_a", F.concat(F.lit("A: "), "n", F.lit(" brand "), "b", F.lit(" size "), "s", F.lit(". B candidates: "), "t").alias("query"))


def alias_checks(scored: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """(item_id_a, aliases): for each partner with a brand on both sides, in order, (b_index, a_brand, b_brand, are_aliases)."""
    rows = scored.where((F.trim("brand_a") != "") & (F.trim("brand_b") != ""))
    same = text.canonical_brand(F.lower("brand_a"), aliases) == text.canonical_brand(F.lower("brand_b"), aliases)
    one = F.struct((F.col("rank") - 1).cast("int").alias("b_index"), F.lower("brand_a").alias("a_brand"), F.lower("brand_b").alias("b_brand"), same.alias("are_aliases"))
    return rows.groupBy("item_id_a").agg(F.array_sort(F.collect_list(one)).alias("aliases"))


def build(scored: DataFrame, indexed: DataFrame, targets: DataFrame, categories: DataFrame, embedder=knowledge.embed, ks: dict[str, int] | None = None, aliases: dict[str, str] | None = None, keep=lambda df: df) -> DataFrame:
    """The context of each record of A: (item_id_a, rules, accepted, rejected, aliases, bridge_hint).

    scored: as for query_text. indexed: entries with vectors. targets: sure_targets(). categories: (item_id_a, category). Each
    type is searched on its own, so a common type can't crowd out another, and each distinct query text once. keep: holds a table
    that is read several times.
    """
    ks = ks or {"rule": 3, "accepted_example": 2, "rejected_example": 2}
    asked = keep(query_text(scored).withColumn("hash", F.sha2("query", 256)))
    queries = keep(embedder(asked.select("hash", F.col("query").alias("text")).dropDuplicates(["hash"])).select(F.col("hash").alias("id"), "vector"))
    told, contexts = indexed.select(F.col("id").alias("id_b"), "title", "content"), queries.select(F.col("id").alias("hash"))
    for kind, k in ks.items():
        found = similarity.dense_topk(queries, indexed.where(F.col("type") == kind).select("id", "vector"), k, 0.0).join(told, "id_b")
        listed = F.array_sort(F.collect_list(F.struct("rank", F.col("id_b").alias("id"), "title", "content", F.col("score"))))
        contexts = contexts.join(found.groupBy(F.col("id_a").alias("hash")).agg(listed.alias({"rule": "rules", "accepted_example": "accepted", "rejected_example": "rejected"}.get(kind, kind))), "hash", "left")
    out = asked.select("item_id_a", "hash").join(contexts, "hash").drop("hash")
    hint = F.concat(F.lit("A category "), quoted(F.col("category")), F.lit(" typically maps to B categories: "), F.col("hint"))
    hints = categories.join(bridge_hints(targets), F.lower("category") == F.col("a_category")).select("item_id_a", hint.alias("bridge_hint"))
    return out.join(alias_checks(scored, aliases), "item_id_a", "left").join(hints, "item_id_a", "left")


def prompt_block() -> Column:
    """A context of build() as lines under five headings; examples are cut at 300 characters."""
    c = F.col
    lines = lambda heading, items, line: F.when(F.size(items) > 0, F.concat_ws("\n", F.lit(heading), F.array_join(F.transform(items, line), "\n")))
    example = lambda x: F.concat(F.lit("- "), x["title"], F.lit(": "), F.substring(x["content"], 1, 300))
    alias = lambda x: F.concat(F.lit("- B["), x["b_index"].cast("string"), F.lit("]: A.brand="), quoted(x["a_brand"]), F.lit(" vs B.brand="), quoted(x["b_brand"]), F.lit(" -> are_aliases="), F.initcap(x["are_aliases"].cast("string")))
    return F.concat_ws(
        "\n", lines("Relevant rules:", c("rules"), lambda x: F.concat(F.lit("- ("), x["title"], F.lit(") "), x["content"])), lines("Brand alias checks:", c("aliases"), alias),
        F.when(c("bridge_hint").isNotNull(), F.concat(F.lit("Category bridge: "), c("bridge_hint"))), lines("Similar accepted examples:", c("accepted"), example), lines("Similar rejected examples:", c("rejected"), example),
    )


def context_signature() -> Column:
    """16 hexadecimal digits that change with what a context of build() holds."""
    c = F.col
    ids = lambda kind, items: F.transform(F.coalesce(items, F.array()), lambda x: F.concat(F.lit(f"{kind}:"), x["id"]))
    alias = F.transform(F.coalesce(c("aliases"), F.array()), lambda x: F.concat_ws("|", F.concat(F.lit("alias:"), x["a_brand"]), x["b_brand"], x["are_aliases"].cast("int").cast("string")))
    hint = F.when(c("bridge_hint").isNotNull(), F.array(F.concat(F.lit("bridge:"), c("bridge_hint")))).otherwise(F.array().cast("array<string>"))
    return knowledge.signature(F.array_join(F.concat(ids("rule", c("rules")), alias, hint, ids("acc", c("accepted")), ids("rej", c("rejected"))), "|"))


def pair_prompt(pairs: DataFrame) -> Column:
    """Both products of a pair as lines."""
    side = lambda s: F.concat(F.lit(f"Store {s.upper()} product:\n"), *[F.concat(F.lit(f"  {k}: "), F.coalesce(F.col(f"{k}_{s}"), F.lit("")), F.lit("\n")) for k in ("name", "brand", "size", "category")])
    return F.concat(side("a"), side("b"))


class Retriever(Protocol):
    """A source of candidate pairs: (item_id_a, item_id_b, source, score, ...)."""

    def __call__(self, a: DataFrame, b: DataFrame) -> DataFrame: ...


def strict_blocks(k: int = 3) -> Retriever:
    return lambda a, b: strict_block_top(a, b, k).withColumn("source", F.lit("T1"))


def sparse_texts(k: int = 20, floor: float = 0.4) -> Retriever:
    def found(a: DataFrame, b: DataFrame) -> DataFrame:
        near = similarity.sparse_topk(*(d.select(F.col(f"item_id_{s}").alias("id"), F.trim(F.concat_ws(" ", f"name_norm_{s}", f"brand_norm_{s}", f"category_norm_{s}")).alias("text")) for d, s in ((a, "a"), (b, "b"))), k, floor)
        return near.select(F.col("id_a").alias("item_id_a"), F.col("id_b").alias("item_id_b"), F.lit("T3").alias("source"), (100 * F.col("score")).alias("score"), F.col("score").alias("cosine"))

    return found


def private_labels(bridge: DataFrame, k: int = 5) -> Retriever:
    return lambda a, b: private_label_top(a, b, bridge, k).withColumn("source", F.lit("T5"))
