"""Document fingerprints: one-permutation MinHash with optimal densification and packed low-order bits.

Every word shingle is hashed once. The top bits of a hash give its bin, each bin keeps its smallest hash. An
empty bin takes the value of the filled bin that comes first in an order drawn for that empty bin, which is
the same for all documents. ``BITS`` low-order bits of each bin are packed as one hexadecimal digit. Of two
fingerprints the share m of equal bins overstates the likeness by chance hits at rate c = 2^-BITS; (m - c) /
(1 - c) corrects it. DataFrame functions only; a text's hashes never leave its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.common import ascii_lower, once, partitions

SHINGLE = 5
BIN_BITS = 7
BINS = 1 << BIN_BITS
BITS = 4


def text_words(text: Column) -> Column:
    """Words of the lower-cased text; words are what stands between ASCII white space."""
    return F.filter(F.split(ascii_lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingle_hashes(words: Column, size: int = SHINGLE) -> Column:
    """Distinct hashes of all runs of ``size`` words in ascending order; one of all words if there are fewer."""
    runs = F.transform(
        F.sequence(F.lit(0), F.size(words) - size), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)])
    )
    few = F.when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))
    return F.array_sort(F.array_distinct(F.when(F.size(words) < size, few).otherwise(runs)))


def bin_of(value: Column) -> Column:
    """Top bits of a signed hash, in ascending order of the hash."""
    return (F.shiftright(value, 64 - BIN_BITS) + BINS // 2).cast("int")


def fingerprinted(df: DataFrame, text: str, into: str) -> DataFrame:
    """Add the fingerprint of column ``text``: BINS hexadecimal digits, the empty string without words.

    The steps go through generators, so that each is evaluated once a row.
    """
    df = once(df, _w=text_words(F.col(text)))
    df = once(df, _h=shingle_hashes(F.col("_w"))).drop("_w")
    # Hashes are sorted, so the first one of a bin is the bin's smallest.
    first = F.filter("_h", lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get("_h", i - 1))))
    df = once(df, _m=first).drop("_h")
    digit = F.transform("_m", lambda h: F.lower(F.hex(h.bitwiseAND(F.lit((1 << BITS) - 1)))))
    df = once(df, _b=F.transform("_m", bin_of), _d=digit).drop("_m")

    def borrowed(bin_: Column) -> Column:
        order = F.zip_with("_b", "_d", lambda other, d: F.struct(F.xxhash64(bin_, other).alias("o"), d.alias("d")))
        return F.array_min(order)["d"]

    def of_bin(bin_: Column) -> Column:
        at = F.array_position("_b", bin_).cast("int")
        return F.when(at > 0, F.get("_d", at - 1)).otherwise(borrowed(bin_))

    bins = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), of_bin)
    value = F.when(F.size("_b") > 0, F.array_join(bins, "")).otherwise(F.lit(""))
    return once(df, **{into: value}).drop("_b", "_d")


def likeness(a: str, b: str) -> Column:
    """Bias-corrected share of equal bins, cut to 0..1; two empty fingerprints are alike, one empty is not."""

    def half(name: str, number: int) -> Column:
        """8 digits as a long."""
        return F.conv(F.substring(name, 8 * number + 1, 8), 16, 10).cast("bigint")

    unequal = []
    for number in range(BINS // 8):
        d = half(a, number).bitwiseXOR(half(b, number))
        d = d.bitwiseOR(F.shiftright(d, 1))
        d = d.bitwiseOR(F.shiftright(d, 2)).bitwiseAND(F.lit(0x11111111).cast("bigint"))
        unequal.append(F.bit_count(d))
    share = 1 - sum(unequal[1:], unequal[0]) / F.lit(float(BINS))
    chance = 1.0 / (1 << BITS)
    fair = F.greatest(F.lit(0.0), (share - chance) / (1 - chance))
    return F.when((F.col(a) == "") | (F.col(b) == ""), (F.col(a) == F.col(b)).cast("double")).otherwise(fair)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with ``fingerprint`` (replaces one of that name). Null text counts as empty."""
    kept = [c for c in docs.columns if c != "fingerprint"]
    named = docs.select(F.struct(*kept).alias("_row"), F.coalesce("text", F.lit("")).alias("_text"))
    return fingerprinted(named, "_text", "fingerprint").select("_row.*", "fingerprint")


def ringed(rows: DataFrame, ranges: int) -> DataFrame:
    """``rows`` (doc_id, text) with ``_part``, ``_order``, ``_ghost``: doc_id ranges that a window can walk through.

    Range 0 holds the largest ids, null ids are in the last. Each range ends with a ghost: a copy of the first row
    of the range after it (after the last range: of the first), so that no row has to look beyond its range.
    """
    cuts = rows.select(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 10 * ranges + 1000)).first()[0] \
        if ranges > 1 else None
    cuts = sorted(set(cuts or []))
    doc = F.col("doc_id")
    part = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c >= doc)) if cuts else F.lit(0)
    part = F.when(doc.isNull(), F.lit(len(cuts) + 1)).otherwise(part)
    dealt = rows.withColumns({"_part": part, "_order": F.xxhash64("text")})
    place = F.struct(doc.isNull().alias("n"), (-doc.cast("decimal(20,0)")).alias("d"), "_order")
    first = dealt.groupBy("_part").agg(F.min_by(F.struct("doc_id", "_order"), place).alias("f")).orderBy("_part").collect()
    after = first[1:] + first[:1]  # one row a range
    heads = [(here["_part"], then["f"]["doc_id"], then["f"]["_order"]) for here, then in zip(first, after, strict=True)]
    kind = rows.schema["doc_id"].dataType.simpleString()
    heads = rows.sparkSession.createDataFrame(heads, f"_to int, _id {kind}, _hash bigint")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_order") == F.col("_hash"))
    ghosts = dealt.join(F.broadcast(heads), same).dropDuplicates(["_to"])
    ghosts = ghosts.select("doc_id", "text", F.col("_to").alias("_part"), "_order", F.lit(True).alias("_ghost"))
    return dealt.withColumn("_ghost", F.lit(False)).unionByName(ghosts)


def edited_fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness; one row per input row.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The edited
    text has its last floor(n_chars / 2) code points replaced by the first as many (or all) of the next document
    in descending doc_id; after the last comes the first. Null texts count as empty. Rows with one doc_id stand
    in order of their texts' hashes; null ids come last. A single document is its own next.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    dealt = fingerprinted(ringed(rows, ranges or 2 * partitions(spark)), "text", "fingerprint")
    order = Window.partitionBy("_part").orderBy("_ghost", F.desc_nulls_last("doc_id"), "_order")
    ahead = dealt.withColumn("_next", F.lead(F.struct("text", "fingerprint")).over(order)).filter("not _ghost")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half),
                      F.substring(F.col("_next.text"), F.lit(1), half))
    rows = ahead.select("doc_id", "fingerprint", F.length("text").cast("bigint").alias("n_chars"),
                        F.col("_next.fingerprint").alias("_next"), edited.alias("_edited"))
    rows = fingerprinted(once(rows, _edited=F.col("_edited")), "_edited", "edited_fingerprint")
    return rows.select(
        "doc_id", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "_next").alias("near_next"),
    )
