"""Column expressions: time, flags, counters, labels and text cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.entities import unescape
from threadloom.labels import LABELS, NEGATIVE, NEGATIVE_TO, NEUTRAL, POSITIVE, POSITIVE_FROM

# Unicode white space plus the four separators U+001C to U+001F.
SPACE = r"[\s\x1c-\x1f]"
LINK = rf"(?iU)https?://[^\s\x1c-\x1f]+|www\.[^\s\x1c-\x1f]+"


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once per row.

    Plain projections get copied into every filter that later uses them. The output of a generator does
    not, so costly expressions go through one; it adds no exchange.
    """
    kept = [F.col(name) for name in df.columns if name not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


# --- time ---------------------------------------------------------------------------------------


def parse_utc(col: Column) -> Column:
    """ISO-8601 text to an instant; null and unreadable text become null."""
    return F.try_to_timestamp(col)


def to_zulu(ts: Column) -> Column:
    """Instant to ISO-8601 text with a Z; microseconds are shown only where there are any."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    exact = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return F.when(F.date_trunc("second", ts) == ts, whole).otherwise(exact)


def in_window(ts: Column, after: Column | None = None, before: Column | None = None) -> Column:
    """Both ends inclusive and optional; rows without a timestamp stay."""
    inside = F.lit(True)
    if after is not None:
        inside = inside & (ts >= after)
    if before is not None:
        inside = inside & (ts <= before)
    return ts.isNull() | inside


def month_of(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def quarter_of(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy"), F.lit("Q"), F.quarter(ts).cast("string"))


def period_start(ts: Column, unit: str) -> Column:
    return F.date_trunc(unit, ts).cast("date")


# --- flags and counters -------------------------------------------------------------------------


def is_reply(flag: Column) -> Column:
    return F.coalesce(F.lower(flag.cast("string")).isin("false", "0"), F.lit(False))


def is_top_level(flag: Column, words: tuple[str, ...] = ("true", "1")) -> Column:
    return F.coalesce(F.lower(flag.cast("string")).isin(*words), F.lit(False))


def count_or_zero(col: Column) -> Column:
    return F.coalesce(col.try_cast("bigint"), F.lit(0).cast("bigint"))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(100 * part, whole), digits)


# --- labels -------------------------------------------------------------------------------------


def label_from_compound(score: Column) -> Column:
    """NaN compares as larger than every number here, so it gets its own branch."""
    return (
        F.when(score.isNull() | F.isnan(score), NEUTRAL)
        .when(score >= POSITIVE_FROM, POSITIVE)
        .when(score <= NEGATIVE_TO, NEGATIVE)
        .otherwise(NEUTRAL)
    )


def normalise_label(raw: Column) -> Column:
    low = F.lower(raw)
    return (
        F.when(low.contains("positive") | (low == "label_2"), POSITIVE)
        .when(low.contains("negative") | (low == "label_0"), NEGATIVE)
        .otherwise(NEUTRAL)
    )


def label_rank(label: Column) -> Column:
    """1, 2, 3 in the fixed label order; null for any other text."""
    position = F.array_position(F.array(*[F.lit(x) for x in LABELS]), label)
    return F.nullif(position, F.lit(0).cast("bigint"))


def known_label(label: Column) -> Column:
    return F.when(label.isin(*LABELS), label)


# --- text ---------------------------------------------------------------------------------------


def strip_links(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(text, LINK, " "), f"(?U){SPACE}+", " "))


def clean_text(text: Column) -> Column:
    return F.coalesce(strip_links(unescape(text)), F.lit(""))
