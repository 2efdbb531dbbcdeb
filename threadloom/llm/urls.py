"""URL filters: a blocked Bloom filter of listed canonical URLs in front of an exact hash join.

A list entry is a host and a path prefix; its canonical URL is both in one string. A URL is looked up under
all its host suffixes (at label borders) and all path prefixes of a length that occurs in the list. These
look-ups pass the Bloom filter first: one 512-bit block per key, in a table that is broadcast and whose size
has a fixed bound. Only possible hits go into the exact join with the list, which removes the false
positives. DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import ascii_lower, once

BLOCK_BITS = 512
PROBES = 7  # 9 bits each of one 64-bit hash
BITS_PER_KEY = 12
MAX_BLOCKS = 1 << 17  # 8 MiB of filter bits; a longer list only raises the false-positive rate


def host_of(url: Column) -> Column:
    """Text between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(_rest(url), "^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """Text from the host's end up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _probe(number: int) -> Column:
    return F.shiftrightunsigned(F.col("_h"), 9 * number).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int")


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def clean_list(rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict), one row per canonical URL; a repeated entry blocks if any of its rows does.

    Rows with a null or empty host never fit and go; a null path is the empty prefix; a null verdict blocks.
    """
    rows = rules.select(
        ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"),
        F.coalesce("verdict", F.lit("block")).alias("verdict"),
    ).filter("host <> ''")
    return rows.groupBy("host", "path").agg(F.max("verdict").alias("verdict")).withColumn("rule", F.concat("host", "path"))


def bloom_blocks(keys: DataFrame, count: int, bits_per_key: int = BITS_PER_KEY, max_blocks: int = MAX_BLOCKS):
    """(block, bits): the blocked filter of column ``rule`` as rows of eight longs, and the number of blocks."""
    blocks = max(1, min(max_blocks, -(-count * bits_per_key // BLOCK_BITS)))
    places = keys.select(
        _block(F.col("rule"), blocks).alias("block"), F.xxhash64("rule", F.lit(1)).alias("_h")
    ).select("block", F.explode(F.array(*[_probe(i) for i in range(PROBES)])).alias("place"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("place") % 64)
    word = F.shiftright("place", 6)
    words = [F.bit_or(F.when(word == w, bit).otherwise(F.lit(0).cast("bigint"))) for w in range(BLOCK_BITS // 64)]
    return places.groupBy("block").agg(F.array(*words).alias("bits")), blocks


def judge(
    pages: DataFrame, rules: DataFrame, unlisted: str = "allow", url: str = "url",
    bits_per_key: int = BITS_PER_KEY, max_blocks: int = MAX_BLOCKS,
) -> DataFrame:
    """The columns of ``pages`` and host, path, rule, verdict (these replace input columns of the same name).

    The longest fitting rule wins (characters of host and path; at equal length the longer host). A URL that no
    rule fits gets a null ``rule`` and the verdict ``unlisted``; so does a null URL, whose host and path are
    empty. Rows are neither merged nor dropped. Each distinct host and path is judged once, so a hot URL costs
    one look-up; an empty list or table gives a result of the same schema.
    """
    listed = clean_list(rules)
    stats = listed.agg(F.count("*").alias("n"), F.sort_array(F.collect_set(F.length("path"))).alias("lens")).first()
    # Distinct prefix lengths: at most as many as the longest path has characters.
    lens, count = list(stats["lens"]), stats["n"]
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    rows = pages.select(*kept, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    if not count:
        return rows.select("*", F.lit(None).cast("string").alias("rule"), F.lit(unlisted).alias("verdict"))

    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    prefixes = F.transform(
        F.filter(F.array(*[F.lit(n) for n in lens]), lambda n: n <= F.length("path")),
        lambda n: F.substring(F.col("path"), F.lit(1), n),
    )
    urls = once(rows.select("host", "path").distinct(), suffixes=suffixes, prefixes=prefixes)
    looks = urls.select("host", "path", F.explode("suffixes").alias("s"), "prefixes")
    looks = looks.select("host", "path", "s", F.explode("prefixes").alias("p")).select(
        "host", "path", F.concat("s", "p").alias("rule")
    )
    filter_rows, blocks = bloom_blocks(listed, count, bits_per_key, max_blocks)
    looks = looks.withColumns({"block": _block(F.col("rule"), blocks), "_h": F.xxhash64("rule", F.lit(1))})
    looks = looks.join(F.broadcast(filter_rows), "block")  # at most MAX_BLOCKS rows of 64 bytes

    def is_set(number: int) -> Column:
        place = _probe(number)
        word = F.element_at("bits", F.shiftright(place, 6) + 1)
        return F.call_function("shiftrightunsigned", word, place % 64).bitwiseAND(F.lit(1)) == 1

    maybe = looks.filter(reduce(lambda a, b: a & b, [is_set(i) for i in range(PROBES)])).select("host", "path", "rule")
    exact = listed.select("rule", F.length("host").alias("host_length"), "verdict")
    hits = maybe.join(exact, "rule")
    worth = F.struct(F.length("rule"), "host_length")
    best = hits.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), worth).alias("best"))
    # The caller's columns travel in a struct, whatever their names.
    rows = rows.select(F.struct(*[F.col(c) for c in kept]).alias("page"), "host", "path")
    judged = rows.join(best, ["host", "path"], "left")
    return judged.select(
        "page.*", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(unlisted)).alias("verdict"),
    )
