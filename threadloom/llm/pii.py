"""Personal data in texts: patterns propose spans, checksums confirm them, nearby words adjust their score.

Proposals come from one pattern per kind. Their places follow from the texts between them: a text is split at
its matches, and running sums of the lengths give every start. Four base kinds (email, ip, card, phone) are
accepted by their validators alone: address parts, digit counts, the Luhn sum. Two things are added to them:
kinds of their own (iban by its mod-97 sum, ssn by nearby words), and second looks at cards and phones whose
greedy match ran into neighbouring numbers and failed. For a second look the accepted matches are blanked out
and a stricter pattern reads what is left. Added spans need a score of ``ACCEPT``: what the pattern and its
checksum are worth, more with a word of their kind nearby, less with a word that speaks of samples.

Every step works inside its row with DataFrame functions: no exchange, whatever text is frequent or long.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import UPPER, ascii_lower, once

KINDS = ["email", "ip", "card", "phone", "iban", "ssn"]
BASE = KINDS[:4]
NEAR = 40  # code points on each side of a span in which a word counts as nearby
RAISE, LOWER_BY, ACCEPT = 0.2, 0.3, 0.5
CHUNK = 256
MASK = "\u0001"
# Words that speak for a kind, and words that speak of samples.
WORDS = {
    "email": "mail email e-mail contact write",
    "ip": "ip address host server",
    "card": "card visa mastercard amex credit debit payment",
    "phone": "phone tel telephone call mobile cell fax whatsapp",
    "iban": "iban account bank transfer konto",
    "ssn": "ssn social security taxpayer",
}
SAMPLE_WORDS = "example sample test dummy placeholder isbn version"


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str  # for java.util.regex
    plain: str  # the same language for an engine without look-around and possessive repeats
    worth: float


# Runs are read possessively and started at their first character (or where the last match ended), so a long run
# without a match is read once and not once per character.
RULES = {
    "email": Rule("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
                  r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", 0.9),
    "ip": Rule("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
               r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", 0.6),
    "card": Rule("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9]([\x20-]?[0-9])+", 0.8),
    "phone": Rule("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", 0.7),
    "iban": Rule("iban", r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9_])",
                 r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b", 0.7),
    "ssn": Rule("ssn", r"(?<![A-Za-z0-9_])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_])", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", 0.3),
}
AGAIN = {
    "card": Rule("card", r"(?<![A-Za-z0-9_])(?:[0-9]{14,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3})(?![A-Za-z0-9_])",
                 r"\b(?:[0-9]{14,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3})\b", 0.6),
    "phone": Rule("phone", r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![A-Za-z0-9_])",
                  r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}\b", 0.6),
}
# Four parts of at most 255, leading zeros allowed.
IP_PART = "0*(?:25[0-5]|2[0-4][0-9]|[0-1]?[0-9]?[0-9])"
IP = rf"^{IP_PART}(?:\.{IP_PART}){{3}}$"
ALNUM = "0123456789" + UPPER


def nearby(words: str) -> str:
    """Any of the words, not as part of a longer word or of an address; for lower-case text."""
    return rf"(?:^|[^a-z0-9_.@-])(?:{'|'.join(words.split())})(?:$|[^a-z0-9_.@-])"


# --- places ----------------------------------------------------------------------------------------


def running(values: Column) -> Column:
    """Sums of the values before each value. ``values`` is a plain column of integers.

    Prefix sums are built within chunks and over the chunks' totals, so that a text with very many matches
    does not copy an array as long as the text for each of them.
    """
    size = F.size(values)
    chunks = F.when(size > 0, F.transform(
        F.sequence(F.lit(0), F.floor((size - 1) / CHUNK).cast("int")), lambda k: F.slice(values, k * CHUNK + 1, CHUNK)
    )).otherwise(F.array().cast("array<array<int>>"))

    def prefixes(array: Column, start: Column) -> Column:
        return F.aggregate(array, F.array(start), lambda seen, x: F.array_append(seen, F.element_at(seen, -1) + x))

    totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x))
    starts = F.slice(prefixes(totals, F.lit(0)), F.lit(1), F.size(chunks))
    return F.flatten(F.zip_with(chunks, starts, lambda c, start: F.slice(prefixes(c, start), F.lit(1), F.size(c))))


def locate(df: DataFrame, sources: dict[str, tuple[str, str]]) -> DataFrame:
    """For each name -> (text column, pattern): column ``name`` with all matches as (start, value, near).

    Also ``name_gaps``, the texts before, between and after the matches (null without a match). Matches are the
    leftmost ones that do not overlap; ``near`` is the lower-case text on both sides, up to the matches next to it.
    """
    df = once(df, **{f"{n}_hits": F.regexp_extract_all(F.col(t), F.lit(p), F.lit(0)) for n, (t, p) in sources.items()})
    df = once(df, **{f"{n}_gaps": F.when(F.size(f"{n}_hits") > 0, F.split(F.col(t), p, -1)) for n, (t, p) in sources.items()})

    def steps(name: str) -> Column:
        return F.transform(f"{name}_hits", lambda v, i: F.length(F.get(f"{name}_gaps", i)) + F.length(v))

    df = once(df, **{f"{n}_steps": steps(n) for n in sources})

    def found(name: str) -> Column:
        places = F.zip_with(f"{name}_hits", running(F.col(f"{name}_steps")), lambda v, at: F.struct(v.alias("v"), at.alias("at")))

        def one(x: Column, i: Column) -> Column:
            before, after = F.get(f"{name}_gaps", i), F.get(f"{name}_gaps", i + 1)
            near = F.concat(F.substring(before, -NEAR, NEAR), F.lit(" "), F.substring(after, 1, NEAR))
            return F.struct((x["at"] + F.length(before)).alias("start"), x["v"].alias("value"), ascii_lower(near).alias("near"))

        return F.transform(places, one)

    return once(df, **{n: found(n) for n in sources}).drop(*[f"{n}_{part}" for n in sources for part in ("hits", "steps")])


# --- validators --------------------------------------------------------------------------------------


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """14 to 19 digits whose Luhn sum is a multiple of ten."""
    digits = digits_of(value)
    return F.when(F.length(digits).between(14, 19), F.call_function("luhn_check", digits)).otherwise(False)


def mod_97(value: Column) -> Column:
    """15 to 34 letters and digits: the first four moved to the end, letters as 10 to 35, leave 1 modulo 97."""
    bare = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, 1, 4))

    def step(rest: Column, symbol: Column) -> Column:
        code = F.instr(F.lit(ALNUM), symbol) - 1
        return (rest * F.when(code < 10, 10).otherwise(100) + code) % 97

    rest = F.aggregate(F.split(turned, ""), F.lit(0), step)
    return F.when(F.length(bare).between(15, 34), rest == 1).otherwise(False)


VALID = {
    "email": lambda v: F.lit(True), "ip": lambda v: v.rlike(IP), "card": luhn,
    "phone": lambda v: F.length(digits_of(v)).between(10, 15), "iban": mod_97, "ssn": lambda v: F.lit(True),
}


def _spans(array: str, rule: Rule, base: bool) -> Column:
    """Confirmed candidates of a rule as span structs; added ones only with a sufficient score."""
    def span(c: Column) -> Column:
        score = (F.lit(rule.worth) + F.when(c["near"].rlike(nearby(WORDS[rule.kind])), RAISE).otherwise(0.0)
                 - F.when(c["near"].rlike(nearby(SAMPLE_WORDS)), LOWER_BY).otherwise(0.0))
        return F.struct(
            c["start"].alias("start"), F.lit(KINDS.index(rule.kind)).alias("rank"), (c["start"] + F.length(c["value"])).alias("end"),
            F.lit(rule.kind).alias("kind"), c["value"].alias("value"), F.round(F.least(score, F.lit(1.0)), 2).alias("score"),
            F.lit(base).alias("base"),
        )

    spans = F.transform(F.filter(array, lambda c: VALID[rule.kind](c["value"])), span)
    return spans if base else F.filter(spans, lambda s: s["score"] >= ACCEPT)


def personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` and ``pii``: all spans of each whole text, by start, then kind (in order of ``KINDS``).

    A span is (start, rank, end, kind, value, score, base): places in code points, end exclusive; ``base`` tells
    the accepted matches of the four base kinds, which always stay, from added ones. Spans of different kinds may
    overlap, spans of one kind do not. Null and empty texts have no spans. Rows are neither merged nor dropped;
    an input column named ``pii`` is replaced, others are kept whatever their names; an empty table gives an
    empty result.
    """
    kept = [c for c in docs.columns if c != "pii"]
    rows = docs.select(F.struct(*kept).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = locate(rows, {kind: ("text", rule.pattern) for kind, rule in RULES.items()})

    # Second looks: the text with accepted matches blanked out, where some match has failed.
    def masked(kind: str) -> Column:
        def shown(v: Column) -> Column:
            return F.when(VALID[kind](v), F.repeat(F.lit(MASK), F.length(v))).otherwise(v)

        parts = F.zip_with(f"{kind}_gaps", F.transform(kind, lambda c: shown(c["value"])), lambda g, v: F.concat(g, F.coalesce(v, F.lit(""))))
        failed = F.exists(kind, lambda c: ~VALID[kind](c["value"]))
        return F.when(failed, F.array_join(parts, "")).otherwise(F.lit(""))

    rows = once(rows, **{f"{kind}_left": masked(kind) for kind in AGAIN})
    rows = locate(rows, {f"{kind}_again": (f"{kind}_left", rule.pattern) for kind, rule in AGAIN.items()})
    spans = [_spans(kind, rule, kind in BASE) for kind, rule in RULES.items()]
    spans += [_spans(f"{kind}_again", rule, False) for kind, rule in AGAIN.items()]
    return once(rows, pii=F.array_sort(F.concat(*spans))).select("row.*", "pii")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans from rows with ``pii``."""
    base = F.filter("pii", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("pii")).alias("spans"))

