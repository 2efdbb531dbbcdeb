"""Sentiment scores by word lexicon and by a caller's model."""

from __future__ import annotations

import inspect
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.functions import columns as C
from threadloom.functions import lexicon as X
from threadloom.session import Scratch

# --- lexicon ------------------------------------------------------------------------------------
# Everything below works on the word array of one text: no word leaves its row, so scoring is a narrow
# projection without any exchange, however long or frequent a text is.

_EDGE = "|".join(re.escape(p) for p in sorted(X.EDGE_PUNCTUATION, key=len, reverse=True))
_LEADING = rf"(?<!\S)(?:{_EDGE})([^\p{{Punct}}\s]{{2,}}+)(?!\S)"
_TRAILING = rf"(?<!\S)([^\p{{Punct}}\s]{{2,}}+)(?:{_EDGE})(?!\S)"


# White space other than the plain space (printable ASCII is told apart first); marks that can be taken off.
_ODD_SPACE = r"[^ -~](?<=[\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000])"
_EDGE_MARKS = "".join(sorted({c for p in X.EDGE_PUNCTUATION for c in p}))


def words_of(text: Column, short: list[str] | None = None) -> Column:
    """Words longer than one character; one edge mark is taken off a word that has no other punctuation.

    ``short``: single characters, such as emoji of the lexicon, that count as words too. Texts with plain spaces only,
    as cleaning leaves them, are split first, and only words with a mark at an end are looked at; the patterns say the
    same for all other texts.
    """
    def bare(part: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(part, _LEADING, "$1"), _TRAILING, "$1")

    def counts(word: Column) -> Column:
        return (F.length(word) > 1) | F.lower(word).isin(*short) if short else F.length(word) > 1

    def plain(word: Column) -> Column:
        core = F.btrim(word, F.lit(_EDGE_MARKS))
        one_end = F.startswith(word, core) | F.endswith(word, core)
        mark = F.replace(word, core, F.lit("")).isin(*X.EDGE_PUNCTUATION)
        return F.when(core == word, word).when(
            (F.length(core) > 1) & one_end & mark & ~core.rlike(r"\p{Punct}"), core).otherwise(word)

    spaced = F.transform(F.split(text, " "), plain)
    return F.filter(F.when(text.rlike(_ODD_SPACE), F.split(bare(text), r"(?U)[\s\x1c-\x1f]+")).otherwise(spaced), counts)


def in_capitals(word: Column) -> Column:
    return (F.upper(word) == word) & (F.lower(word) != word)


@dataclass(frozen=True)
class _Effects:
    """What the lists say about the word at a position: functions from a position to a column."""

    value: Callable[[Column], Column]
    valued: Callable[[Column], Column]  # whether there is a value
    boost: Callable[[Column], Column]
    negates: Callable[[Column], Column]
    acts: Callable[[Column], Column]  # whether a word can change a later one; false only where it cannot


def _neighbour(acc: Column, k: Column, i: Column, said: _Effects) -> Column:
    """Effect of the word ``k + 1`` places before word ``i`` on the valence so far."""
    low = F.col("_low")
    j = i - k - 1
    word = F.get(low, j)
    boost = F.coalesce(said.boost(j), F.lit(0.0))
    loud = F.col("_mixed") & in_capitals(F.get("_words", j)) & (boost != 0)
    boosted = (
        F.when(acc < 0, -boost).otherwise(boost)
        + F.when(loud, F.when(acc > 0, X.CAPITALS).otherwise(-X.CAPITALS)).otherwise(0.0)
    )
    damping = F.get(F.array(*[F.lit(d) for d in X.DAMPING]), k)
    so_this = [F.coalesce(F.get(low, i - d).isin("so", "this"), F.lit(False)) for d in (1, 2)]
    never = word == "never"
    factor = (
        F.when((k == 1) & never & so_this[0], X.NEVER_NEAR)
        .when((k == 2) & never & (so_this[0] | so_this[1]), X.NEVER_FAR)
        .when(said.negates(j), X.NEGATION)
        .otherwise(1.0)
    )
    counts = (i > k) & (never | said.acts(j)) & ~said.valued(j)
    return F.when(counts, (acc + boosted * damping) * factor).otherwise(acc)


def _valence(place: Column, said: _Effects) -> Column:
    """Valence of the word at a place (at, value)."""
    i, value = place["at"], place["value"]
    low, word = F.col("_low"), F.get("_words", i)
    kind_of = (F.get(low, i) == "kind") & F.coalesce(F.get(low, i + 1) == "of", F.lit(False))
    silent = kind_of | said.boost(i).isNotNull()
    louder = F.when(value > 0, value + X.CAPITALS).otherwise(value - X.CAPITALS)
    start = F.when(F.col("_mixed") & in_capitals(word), louder).otherwise(value)
    steps = F.array(F.lit(0), F.lit(1), F.lit(2))
    near = F.aggregate(steps, start, lambda acc, k: _neighbour(acc, k, i, said))
    spared = F.coalesce(F.get(low, i - 2).isin("at", "very"), F.lit(False))
    least = F.coalesce((F.get(low, i - 1) == "least") & ~said.valued(i - 1), F.lit(False)) & ~spared
    but = F.when(F.col("_but") == 0, 1.0).when(i + 1 < F.col("_but"), X.BEFORE_BUT)
    but = but.when(i + 1 > F.col("_but"), X.AFTER_BUT).otherwise(1.0)
    return F.when(silent, 0.0).otherwise(near * F.when(least, X.NEGATION).otherwise(1.0) * but)


def _total(array: Column, part) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda acc, x: acc + part(x))


def _marks(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _scores(df: DataFrame, text: str, said: _Effects) -> DataFrame:
    """Add the score columns to rows with ``_words`` and ``_low``. Only words with a value have a valence to work out."""
    # Most words are in lower case already and are left after one comparison.
    loud = F.size(F.filter("_words", lambda w, i: (F.get("_low", i) != w) & (F.upper(w) == w)))

    def valued(word: Column, i: Column) -> Column:
        return F.when(said.valued(i), F.struct(i.alias("at"), said.value(i).alias("value")))

    places = F.filter(F.array_compact(F.transform("_low", valued)), lambda x: ~F.isnan(x["value"]))
    df = C.computed(df, _mixed=(loud > 0) & (loud < F.size("_words")), _but=F.array_position("_low", "but"), _places=places)
    df = C.computed(df, _s=F.transform("_places", lambda x: _valence(x, said)))
    questions, exclamations = _marks(F.col(text), "?"), _marks(F.col(text), "!")
    emphasis = F.least(exclamations, F.lit(X.MAX_EXCLAMATIONS)) * X.EXCLAMATION + (
        F.when(questions <= 1, 0.0).when(questions <= 3, questions * X.QUESTION).otherwise(X.MANY_QUESTIONS)
    )
    df = df.withColumns({
        "_emph": emphasis,
        "_sum": _total(F.col("_s"), lambda x: x),
        "_up": _total(F.col("_s"), lambda x: F.when(x > 0, x + 1).otherwise(0.0)),
        "_down": _total(F.col("_s"), lambda x: F.when(x < 0, 1 - x).otherwise(0.0)),
        "_zero": F.size("_words") - F.size(F.filter("_s", lambda x: x != 0)),
    })
    emph, up, down = F.col("_emph"), F.col("_up"), F.col("_down")
    df = df.withColumns({
        "_sum": F.when(F.col("_sum") > 0, F.col("_sum") + emph)
        .when(F.col("_sum") < 0, F.col("_sum") - emph).otherwise(0.0),
        "_up": F.when(up > down, up + emph).otherwise(up),
        "_down": F.when(up < down, down + emph).otherwise(down),
    })
    mass = F.col("_up") + F.col("_down") + F.col("_zero")

    def share(part: str) -> Column:
        return F.when(mass > 0, F.round(F.col(part) / mass, 3)).otherwise(0.0)

    compound = F.col("_sum") / F.sqrt(F.col("_sum") * F.col("_sum") + X.NORMALISER)
    df = C.computed(
        df, vader_neg=share("_down"), vader_neu=share("_zero"), vader_pos=share("_up"),
        vader_compound=F.round(compound, 4),
    ).withColumn("sentiment_method", F.lit("vader"))
    df = df.withColumn("vader_label", C.label_from_compound(F.col("vader_compound")))
    return df.withColumns({"sentiment_label": F.col("vader_label"), "sentiment_score": F.col("vader_compound")})


_HELPERS = ["_words", "_low", "_chosen", "_single", "_marks", "_values", "_boosts", "_negated", "_mixed", "_but", "_places", "_s",
            "_emph",
            "_sum", "_up", "_down", "_zero"]


def _with_words(df: DataFrame, text: str, short: list[str]) -> DataFrame:
    df = C.computed(df, _words=words_of(F.coalesce(F.col(text), F.lit("")), short))
    return C.computed(df, _low=F.transform("_words", F.lower))


# A word or phrase found in the lexicon: its place, its number of words and what the lists say about it.
_EFFECT = "struct<value: double, boost: double, negates: boolean>"


def _effect(term: Column, lists: X.Lexicon) -> Column:
    """What the lists say about a term."""
    negates = term.isin(*lists.negations) if lists.negations else F.lit(False)
    return F.struct(X.lookup(term, lists.words).alias("value"), X.lookup(term, lists.boosters).alias("boost"),
                    F.coalesce(negates, F.lit(False)).alias("negates")).cast(_EFFECT)


def _without_overlap(found: Column) -> Column:
    """Of (at, size, effect), sorted by place and the longest first, those that start after the last chosen one."""
    kind = f"array<struct<at: int, size: int, effect: {_EFFECT}>>"

    def step(acc: Column, x: Column) -> Column:
        taken = F.struct((x["at"] + x["size"]).alias("free"), F.array_append(acc["taken"], x).alias("taken"))
        return F.when(x["at"] >= acc["free"], taken).otherwise(acc)

    start = F.struct(F.lit(0).alias("free"), F.array().cast(kind).alias("taken"))
    return F.aggregate(found, start, step, lambda acc: acc["taken"])


def _spread(chosen: str, size: Column) -> Column:
    """An effect per word position, null outside of the chosen terms.

    The value of a phrase sits on its first word, what it does to later words on its last one, as neighbours look
    backwards. Its other words have a value of NaN: they neither count themselves nor act on others.
    """
    inert = F.struct(F.lit(float("nan")).alias("value"), F.lit(None).alias("boost"), F.lit(False).alias("negates")).cast(_EFFECT)
    free = F.lit(None).cast(_EFFECT)

    def words(x: Column) -> Column:
        valued = x["effect"]["value"].isNotNull()
        rest = F.array_repeat(inert, x["size"] - 1)
        return F.when(valued, F.concat(F.array(x["effect"]), rest)).otherwise(F.concat(rest, F.array(x["effect"])))

    def end(i: Column) -> Column:
        before = F.get(chosen, i - 1)
        return F.when(i > 0, before["at"] + before["size"]).otherwise(0)

    parts = F.transform(chosen, lambda x, i: F.concat(F.array_repeat(free, x["at"] - end(i)), words(x)))
    return F.concat(F.flatten(parts), F.array_repeat(free, size - end(F.size(chosen))))


def _from_lists(lists: X.Lexicon) -> _Effects:
    """Words are looked up where they are asked for; a phrase (``_marks``) comes before its words."""
    def both(i: Column, of_mark: str, of_word: Callable[[Column], Column]) -> Column:
        mark = F.get("_marks", i)
        return F.when(mark.isNotNull(), mark[of_mark]).otherwise(of_word(F.get("_low", i)))

    def negates(word: Column) -> Column:
        listed = word.isin(*lists.negations) if lists.negations else F.lit(False)
        return F.coalesce(listed | word.contains("n't"), F.lit(False))

    def valued(i: Column) -> Column:
        mark = F.get("_marks", i)
        return F.when(mark.isNotNull(), mark["value"].isNotNull()).otherwise(F.coalesce(F.get("_low", i).isin(*lists.words), F.lit(False)))

    def acts(i: Column) -> Column:
        word = F.get("_low", i)
        return F.get("_marks", i).isNotNull() | word.isin(*lists.boosters, *lists.negations) | word.contains("n't")

    return _Effects(
        value=lambda i: both(i, "value", lambda w: X.lookup(w, lists.words)), valued=valued,
        boost=lambda i: both(i, "boost", lambda w: X.lookup(w, lists.boosters)),
        negates=lambda i: F.coalesce(both(i, "negates", negates), F.lit(False)), acts=acts,
    )


def _from_arrays() -> _Effects:
    def get(name: str) -> Callable[[Column], Column]:
        return lambda i: F.get(name, i)

    return _Effects(get("_values"), lambda i: F.get("_values", i).isNotNull(), get("_boosts"), get("_negated"), lambda i: F.lit(True))


def _with_effects(df: DataFrame) -> DataFrame:
    """``_values``, ``_boosts`` and ``_negated`` per word: a phrase's (``_marks``) before the word's own (``_single``)."""
    def both(i: Column) -> Column:
        return F.coalesce(F.get("_marks", i), F.get("_single", i))

    def negated(word: Column, i: Column) -> Column:
        plain = F.get("_marks", i).isNull() & word.contains("n't")
        return F.coalesce(both(i)["negates"], F.lit(False)) | plain

    return C.computed(
        df, _values=F.transform("_low", lambda w, i: both(i)["value"]), _boosts=F.transform("_low", lambda w, i: both(i)["boost"]),
        _negated=F.transform("_low", negated),
    )


def lexicon_sentiment(
    df: DataFrame, lexicon: X.Lexicon | DataFrame | None = None, text: str = "textClean",
    scratch: Scratch | None = None,
) -> DataFrame:
    """Shares of negative, neutral and positive words, the compound score and its label.

    ``lexicon``: word lists, or a table (term, valence, kind); kinds are word, booster and negation, terms may have
    several words, and repeated rows are settled as in ``tidy``. Phrases are found from left to right, the longest
    first, and take their words out of the single-word look-up. A table that is too large to travel in the plan is
    joined instead, with the same result.
    """
    if isinstance(lexicon, DataFrame):
        table = X.tidy(lexicon)
        if not X.fits_plan(table):
            return _by_join(df, table, text, scratch or Scratch(df.sparkSession, "lexicon"))
        lexicon = X.from_rows(table.collect())
    lists = lexicon or X.Lexicon()
    phrases = lists.phrases()
    df = _with_words(df, text, lists.single_characters())
    marks = F.lit(None).cast(f"array<{_EFFECT}>")
    if phrases:
        def place(word: Column, i: Column) -> Column:
            return F.struct(i.alias("at"), X.longest_phrase(F.col("_low"), i, phrases).alias("size"))

        def named(x: Column) -> Column:
            term = F.array_join(F.slice("_low", x["at"] + 1, x["size"]), " ")
            return F.struct(x["at"], x["size"], _effect(term, lists).alias("effect"))

        found = F.transform(F.filter(F.transform("_low", place), lambda x: x["size"] > 0), named)
        df = C.computed(df, _chosen=_without_overlap(found))
        marks = F.when(F.size("_chosen") > 0, _spread("_chosen", F.size("_low")))
    df = C.computed(df, _marks=marks)
    return _scores(df, text, _from_lists(lists)).drop(*_HELPERS)


def _by_join(df: DataFrame, table: DataFrame, text: str, scratch: Scratch) -> DataFrame:
    """``table`` is tidy. Every run of words as long as some term meets the terms, in one exchange."""
    table = scratch.table(table, "terms")
    # Single characters are at most as many as there are characters; lengths as many as the longest term has words.
    short = [r["term"] for r in table.filter(F.length("term") == 1).select("term").distinct().collect()]
    sizes = sorted(r[0] for r in table.select(F.size(F.split("term", " ")).alias("n")).distinct().collect())

    def of(kind: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col("valence")))

    effect = F.struct(of("word").alias("value"), of("booster").alias("boost"), of("negation").isNotNull().alias("negates"))
    terms = table.groupBy(F.col("term").alias("_term")).agg(effect.cast(_EFFECT).alias("effect"))
    rows = scratch.table(_with_words(df, text, short).withColumn("_row", F.monotonically_increasing_id()), "texts")
    places = rows.select("_row", F.posexplode("_low").alias("at", "_w"), "_low").select(
        "_row", "at", F.explode(F.array(*[F.lit(n) for n in sizes])).alias("size"), "_low"
    ).filter(F.col("at") + F.col("size") <= F.size("_low"))
    runs = places.select("_row", "at", "size", F.array_join(F.slice("_low", F.col("at") + 1, F.col("size")), " ").alias("_term"))
    found = runs.join(terms, "_term").groupBy("_row").agg(
        F.array_sort(F.collect_list(F.struct("at", (-F.col("size")).alias("longest"), "effect"))).alias("_found"))

    def picked(single: bool) -> Column:
        kept = F.filter("_found", lambda x: (x["longest"] == -1) == F.lit(single))
        return F.transform(kept, lambda x: F.struct(x["at"], (-x["longest"]).alias("size"), x["effect"]))

    rows = rows.join(found, "_row", "left")
    rows = C.computed(rows, _chosen=_without_overlap(picked(False)), _alone=picked(True))
    rows = C.computed(
        rows, _marks=F.when(F.size("_chosen") > 0, _spread("_chosen", F.size("_low"))),
        _single=F.when(F.size("_alone") > 0, _spread("_alone", F.size("_low"))),
    )
    return _scores(_with_effects(rows), text, _from_arrays()).drop(*_HELPERS, "_row", "_found", "_alone")


# --- a caller's model ---------------------------------------------------------------------------

BATCH_SIZE = 64
MAX_LENGTH = 256  # tokens of a text that a model reads


def batch_classifier(
    df: DataFrame, make_predict_fn, text: str = "textClean", batch_size: int = BATCH_SIZE,
    method: str = "roberta", max_length: int = MAX_LENGTH,
) -> DataFrame:
    """Label and confidence per text from a model loaded once per Python worker.

    ``make_predict_fn`` returns a function from an array of texts to ``{"label": [...], "score": [...]}``. If it takes
    ``max_length`` it is handed the number of tokens to which its tokenizer has to cut texts. Texts go to the model by
    length within each partition, so that a batch needs little padding; results belong to their row's key.
    """
    if "max_length" in inspect.signature(make_predict_fn).parameters:
        make_predict_fn = partial(make_predict_fn, max_length=max_length)
    kind = T.StructType([T.StructField("label", T.StringType()), T.StructField("score", T.DoubleType())])
    predict = predict_batch_udf(make_predict_fn, return_type=kind, batch_size=batch_size)
    df = df.sortWithinPartitions(F.length(text))
    df = C.computed(df, _out=predict(F.coalesce(F.col(text), F.lit(""))))
    label = C.normalise_label(F.col("_out.label"))
    return df.withColumns({
        "sentiment_method": F.lit(method),
        "roberta_raw_label": F.col("_out.label"),
        "roberta_label": label,
        "roberta_confidence": F.col("_out.score"),
        "sentiment_label": label,
        "sentiment_score": F.col("_out.score"),
    }).drop("_out")
