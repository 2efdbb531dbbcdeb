"""Benchmark decontamination: size-partitioned MinHash containment search with exact verification.

An item with n distinct shingles is contained in a document that holds at least need = ceil(t n) of them; at
most n - need are missing. So a document that contains the item holds at least one of any n - need + 1 of the
item's shingles. The sketch of an item is that many of its smallest shingle hashes (a bottom-k MinHash). Items
are partitioned by their size, which sets need and the sketch's size; documents with fewer shingles than
a size class needs are no candidates for it. The search looks up the hash of every shingle of a document in
the sketches: long documents need no signature of their own, which would be useless for a short item, and no
contained item can be missed. Candidates are verified on the shingles themselves. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import once
from threadloom.llm.fingerprints import text_words

SHINGLE = 5
CONTAINMENT = 0.8


def shingles(words: Column, sizes: list[int]) -> Column:
    """Distinct runs of ``sizes`` words, joined by spaces."""
    def runs(size: int) -> Column:
        found = F.transform(
            F.sequence(F.lit(1), F.size(words) - size + 1), lambda i: F.array_join(F.slice(words, i, size), " ")
        )
        return F.when(F.size(words) >= size, found).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*[runs(s) for s in sizes]))


def hashes(words: Column, sizes: list[int]) -> Column:
    """Hashes of all runs of ``sizes`` words, repeats included."""
    def runs(size: int) -> Column:
        found = F.transform(
            F.sequence(F.lit(0), F.size(words) - size), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)])
        )
        return F.when(F.size(words) >= size, found).otherwise(F.array().cast("array<bigint>"))

    return F.concat(*[runs(s) for s in sizes])


def sketched(items: DataFrame, size: int, threshold: float) -> DataFrame:
    """(item_id, width, shingles, n, need, sketch) of every item with words; repeated rows are one item."""
    rows = once(items.select("item_id", "text").distinct(), _w=text_words(F.col("text")))
    rows = rows.filter(F.size("_w") > 0).withColumn("width", F.least(F.size("_w"), F.lit(size)))
    by_width = [F.when(F.col("width") == w, shingles(F.col("_w"), [w])) for w in range(1, size + 1)]
    hash_width = [F.when(F.col("width") == w, hashes(F.col("_w"), [w])) for w in range(1, size + 1)]
    rows = once(rows, shingles=F.coalesce(*by_width), _h=F.array_sort(F.array_distinct(F.coalesce(*hash_width))))
    n = F.size("shingles")
    # Against a product like 0.8 * 5 that lies a hair above the whole number.
    need = F.greatest(F.lit(1), F.ceil(n * F.lit(threshold) - F.lit(1e-9))).cast("int")
    rows = rows.withColumns({"n": n, "need": need})
    return rows.select("item_id", "width", "shingles", "n", "need",
                       F.slice("_h", F.lit(1), F.col("n") - F.col("need") + 1).alias("sketch"))


def contained_items(
    docs: DataFrame, items: DataFrame, size: int = SHINGLE, threshold: float = CONTAINMENT
) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found, containment) for every item found in a document.

    Shingles are runs of ``size`` words of the lower-cased (A-Z) text; an item with fewer words is one shingle of
    all its words. Found: at least ``threshold`` of an item's distinct shingles are in the document. Items and
    documents without words, and null texts, give no rows. If rows share a doc_id, or items an item_id, the pair
    is listed once, with the highest containment. Null ids are listed like others.
    """
    listed = sketched(items, size, threshold)
    widths = sorted(r[0] for r in listed.select("width").distinct().collect())  # at most ``size`` numbers
    if not widths:
        widths = [size]
    keyed = listed.select("item_id", "need", F.explode("sketch").alias("h"))
    rows = docs.select("doc_id", "text")
    texts = once(rows.select("doc_id", text_words(F.col("text")).alias("_w")), _w=F.col("_w"))
    looks = texts.select("doc_id", F.size("_w").alias("_n"), F.explode(hashes(F.col("_w"), widths)).alias("h"))
    # The sketches are the small side; the runtime plan broadcasts them by their size, or shuffles both sides.
    hits = looks.join(keyed, "h").filter(F.col("_n") * len(widths) >= F.col("need"))
    found = hits.groupBy("doc_id").agg(F.collect_set("item_id").alias("_items"),
                                       F.max(F.col("item_id").isNull()).alias("_nameless"))
    candidates = found.select(F.col("doc_id").alias("_id"), F.when(
        F.col("_nameless"), F.array_append("_items", F.lit(None).cast(items.schema["item_id"].dataType))
    ).otherwise(F.col("_items")).alias("_items"))
    pairs = rows.join(candidates, F.col("doc_id").eqNullSafe(F.col("_id")))
    pairs = once(pairs.select("doc_id", "_items", text_words(F.col("text")).alias("_w")), _w=F.col("_w"))
    pairs = once(pairs, _s=shingles(F.col("_w"), widths)).drop("_w")
    pairs = pairs.select("doc_id", "_s", F.explode("_items").alias("_item"))
    checked = pairs.join(listed.drop("sketch"), F.col("_item").eqNullSafe(F.col("item_id"))).select(
        "doc_id", "item_id", "n", "need", F.size(F.array_intersect("shingles", "_s")).alias("found")
    ).filter(F.col("found") >= F.col("need"))
    share = F.struct((F.col("found") / F.col("n")).alias("containment"), F.col("n").alias("n"), F.col("found").alias("found"))
    best = checked.groupBy("doc_id", "item_id").agg(F.max(share).alias("b"))
    return best.select("doc_id", "item_id", F.col("b.n").cast("bigint").alias("n_shingles"),
                       F.col("b.found").cast("bigint").alias("n_found"), F.col("b.containment").alias("containment"))


def clean_documents(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents in which no item is found, unchanged. Of rows with one doc_id all go if one holds an item."""
    hit = contained_items(docs, items, **options).select(F.col("doc_id").alias("hit")).distinct()
    rows = docs.select(F.struct("*").alias("row"))  # the caller's columns, whatever their names
    return rows.join(hit, F.col("row.doc_id").eqNullSafe(F.col("hit")), "left_anti").select("row.*")
