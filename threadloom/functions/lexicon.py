"""Word lists of the lexicon scorer and their lookups as native expressions."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the published rule set (Hutto & Gilbert 2014).
CAPITALS = 0.733
BOOST = 0.293
NEGATION = -0.74
DAMPING = [1.0, 0.95, 0.9]
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
NEVER_NEAR, NEVER_FAR = 1.5, 1.25
EXCLAMATION, MAX_EXCLAMATIONS = 0.292, 4
QUESTION, MANY_QUESTIONS = 0.18, 0.96
NORMALISER = 15.0
EDGE_PUNCTUATION = [
    ".", "!", "?", ",", ";", ":", "-", "'", '"', "!!", "!!!", "??", "???", "?!?", "!?!", "?!?!", "!?!?",
]
STRONGER = """absolutely amazingly awfully completely considerably decidedly deeply effing enormously entirely especially
exceptionally extremely fabulously flipping flippin fricking frickin frigging friggin fully fucking greatly hella highly
hugely incredibly intensely majorly more most particularly purely quite really remarkably so substantially thoroughly
totally tremendously uber unbelievably unusually utterly very""".split()
WEAKER = """almost barely hardly kinda kindof kind-of less little marginally occasionally partly scarcely slightly
somewhat sorta sortof sort-of""".split() + ["just enough", "kind of", "sort of"]
NEGATIONS = """aint arent cannot cant couldnt darent didnt doesnt dont hadnt hasnt havent isnt mightnt mustnt neither
neednt never none nope nor not nothing nowhere oughtnt shant shouldnt uhuh uh-uh wasnt werent without wont wouldnt rarely
seldom despite""".split()
IDIOMS = {"the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "yeah right": -2.0, "cut the mustard": 2.0,
          "kiss of death": -1.5, "hand to mouth": -2.0}

# A small list of our own, for use without a full table: strength -> words.
WORDS = {
    3.2: "amazing awesome best excellent fantastic masterpiece perfect wonderful",
    2.7: "adorable beautiful brilliant gorgeous great incredible love loved loves superb",
    2.2: "cool delighted enjoy enjoyed excited fun funny glad good happy joy lovely",
    1.7: "better care congrats cute favorite favourite hope hyped laugh like liked nice pretty smile sweet thank "
         "thanks win winner wins",
    1.2: "agree clean clear easy fair fine interesting lucky okay safe support welcome",
    -1.2: "bored boring confused difficult doubt expensive hard lack late lazy miss slow tired weird",
    -1.7: "annoyed annoying bug bugs cry fail failed fake lose loser lost mad problem sad sorry stuck unfair wrong",
    -2.2: "angry broken disappointed disappointing dumb greedy lie lies ruined stupid trash ugly upset useless",
    -2.7: "bad disgusting garbage hate hated hates horrible pain scam terrible toxic worse",
    -3.2: "abuse awful disaster evil hell kill murder worst",
}


def own_words() -> dict[str, float]:
    return {word: value for value, words in WORDS.items() for word in words.split()} | IDIOMS


def own_boosters() -> dict[str, float]:
    return {**{w: BOOST for w in STRONGER}, **{w: -BOOST for w in WEAKER}}


@dataclass(frozen=True)
class Lexicon:
    """Word lists that travel inside the plan. A term of several words, parted by single spaces, is a phrase."""

    words: dict[str, float] = field(default_factory=own_words)
    boosters: dict[str, float] = field(default_factory=own_boosters)
    negations: tuple[str, ...] = tuple(NEGATIONS)

    def terms(self) -> set[str]:
        return {*self.words, *self.boosters, *self.negations}

    def phrases(self) -> list[list[str]]:
        return [term.split(" ") for term in sorted(self.terms()) if " " in term]

    def single_characters(self) -> list[str]:
        return sorted(term for term in self.terms() if len(term) == 1)

    def rows(self, kind: str) -> list[tuple[str, float, str]]:
        lists = {"word": self.words, "booster": self.boosters, "negation": dict.fromkeys(self.negations, 0.0)}
        return [(term, value, kind) for term, value in lists[kind].items()]


KINDS = ("word", "booster", "negation")
# Beyond this many entries a lexicon table is joined instead of being carried in the plan.
PLAN_LIMIT = 20_000


def tidy(table: DataFrame) -> DataFrame:
    """(term, valence, kind) with one row per term and kind: lower case, words parted by single spaces.

    Of repeated rows the strongest stays, the positive one of two equally strong. Rows without a term, or without
    the valence that a word or booster needs, are left out. A kind without any row is filled from our own lists.
    """
    term = F.trim(F.regexp_replace(F.lower("term"), r"(?U)[\s\x1c-\x1f]+", " "))
    valence = F.when(F.col("kind") == "negation", F.lit(0.0)).otherwise(F.col("valence").cast("double"))
    rows = table.select(term.alias("term"), valence.alias("valence"), "kind")
    rows = rows.filter((F.col("term") != "") & F.col("valence").isNotNull() & F.col("kind").isin(*KINDS))
    present = {r["kind"] for r in rows.select("kind").distinct().collect()}  # at most three
    own = [row for kind in KINDS if kind not in present for row in Lexicon().rows(kind)]
    if own:
        rows = rows.unionByName(table.sparkSession.createDataFrame(own, "term string, valence double, kind string"))
    return rows.groupBy("term", "kind").agg(F.max_by("valence", F.struct(F.abs("valence"), "valence")).alias("valence"))


def from_rows(rows) -> Lexicon:
    """Lexicon from the rows of a tidy table."""
    kinds = defaultdict(dict)
    for row in rows:
        kinds[row["kind"]][row["term"]] = row["valence"]
    return Lexicon(words=kinds["word"], boosters=kinds["booster"], negations=tuple(sorted(kinds["negation"])))


def fits_plan(table: DataFrame) -> bool:
    return table.limit(PLAN_LIMIT + 1).count() <= PLAN_LIMIT


def lookup(word: Column, values: dict[str, float]) -> Column:
    """Value of a word, null for words outside the list.

    Membership tests against literal lists run on hash sets. The first one discards nearly all words; the
    others find the value among the few distinct ones.
    """
    groups = defaultdict(list)
    for term, value in values.items():
        groups[value].append(term)
    found = None
    for value, terms in sorted(groups.items()):
        hit = word.isin(*sorted(terms))
        found = F.when(hit, F.lit(float(value))) if found is None else found.when(hit, F.lit(float(value)))
    if found is None:
        return F.lit(None).cast("double")
    return F.when(word.isin(*sorted(values)), found)


def longest_phrase(words: Column, start: Column, phrases: list[list[str]]) -> Column:
    """Words in the longest phrase that begins at ``start`` of an array of words; 0 where none does.

    A walk down the trie of the phrases: each level tests a run of words against the prefixes of that length, so
    that nearly all positions are left after a single test.
    """
    prefixes, ends = defaultdict(set), defaultdict(set)
    for phrase in phrases:
        ends[len(phrase)].add(" ".join(phrase))
        for depth in range(1, len(phrase) + 1):
            prefixes[depth].add(" ".join(phrase[:depth]))

    def walk(depth: int, best: Column) -> Column:
        run = F.get(words, start)
        for k in range(1, depth):
            run = F.concat(run, F.lit(" "), F.get(words, start + k))
        if depth in ends:
            best = F.when(run.isin(*sorted(ends[depth])), depth).otherwise(best)
        if depth + 1 not in prefixes:
            return best
        return F.when(run.isin(*sorted(prefixes[depth])), walk(depth + 1, best)).otherwise(best)

    return walk(1, F.lit(0)) if phrases else F.lit(0)
