"""SQL definitions of the views over the test tables, to be put in front of a query."""

from __future__ import annotations

from threadloom.functions import lexicon as X
from threadloom.labels import LABELS

# A word list for the invented prose of the test tables: a parameter of the scorer like any other.
TEST_WORDS = {
    "best": 3.2, "than": 1.9, "with": 1.6, "from": -1.3, "then": 2.1, "thing": -2.2, "there": -0.8, "have": 1.1,
    "whole": 2.6, "other": -1.7, "inner": 0.9, "seen": 1.4, "heat": -2.4, "shed": -1.1, "thin": -1.5, "stand": 0.7,
    "pour": 1.2, "avec": 1.7, "dans": -1.4, "sur": 0.9, "une": -1.1, "est": 2.3, "qui": -1.9, "elle": 1.3,
    "mit": 1.1, "sich": -1.6, "auf": -0.9, "eine": 1.8, "das": -1.2, "ist": 2.2, "von": -2.1, "der": 0.4,
    "los": -1.8, "las": 1.5, "por": 1.4, "del": -0.6, "una": 2.4, "con": -2.3, "para": 1.9, "como": -1.4,
    # A single character, and phrases that hold, overlap and repeat each other.
    "|": -0.4, "of the": 1.3, "in the": -0.9, "the the": 0.8, "anea eriner": -2.0, "anea eriner thanea": 2.2,
    "thanedble the anea eriner": -1.4, "de de de": 1.1, "mit der": 1.7, "orre orre orre orre": -0.3,
}
TEST_LEXICON = X.Lexicon(
    words=TEST_WORDS,
    boosters={"very": X.BOOST, "la": X.BOOST, "zu": X.BOOST, "to": X.BOOST, "of": -X.BOOST, "le": -X.BOOST, "im": -X.BOOST,
              "de la": X.BOOST, "a the": -X.BOOST},
    negations=("nicht", "pas", "no", "not", "never", "un", "er", "in der", "it the"),
)
STOP_WORDS = ["the", "of", "and", "to", "in", "is", "that", "it", "de", "la", "der", "die", "und", "le", "que", "en"]


def with_(*parts: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(p.strip() for p in parts) + "\n"


def values(rows) -> str:
    return ", ".join(f"({', '.join(repr(v) if isinstance(v, str) else str(v) for v in row)})" for row in rows)


SPACES = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x1c-\x1f]"


def clean(text: str) -> str:
    """The entities that occur in the tables; the ampersand goes last."""
    for name, char in (("quot", '"'), ("copy", "©"), ("middot", "·")):
        text = f"replace({text}, '&{name};', '{char}')"
    text = f"replace(regexp_replace({text}, '&amp;?', chr(1), 'g'), chr(1), '&')"
    text = rf"regexp_replace({text}, '(?i)https?://[^\s]+|www\.[^\s]+', ' ', 'g')"
    return f"trim(regexp_replace({text}, '{SPACES}+', ' ', 'g'))"


COMMENTS = f"""
docev AS (
  SELECT doc_id, text, lang, source, coalesce(ts, TIMESTAMP '2024-01-01') AS ts,
         coalesce(user_id, doc_id % 1000) AS user_id, coalesce(value, 0) AS value,
         date_trunc('week', coalesce(ts, TIMESTAMP '2024-01-01')) AS week
  FROM documents d LEFT JOIN (SELECT event_id, ts, user_id, value FROM events) e ON e.event_id = d.doc_id
),
tops AS (
  SELECT lang, source, week, doc_id AS top, user_id AS target FROM docev
  QUALIFY row_number() OVER (PARTITION BY lang, source, week ORDER BY ts, doc_id) = 1
),
comments AS (
  SELECT lang AS "gameLabel", source AS "videoId",
         'Thread collection of the public source number ' || source AS "videoTitle",
         CAST(doc_id AS VARCHAR) AS "commentId",
         CASE WHEN doc_id <> top THEN CAST(top AS VARCHAR) END AS "parentCommentId",
         lang || '/' || source || '/' || strftime(week, '%Y-%m-%d') AS "threadId",
         doc_id = top AS "isTopLevel",
         'Name ' || (user_id % 400) AS "authorDisplayName",
         'u' || user_id AS "authorChannelId",
         CASE WHEN doc_id <> top THEN 'u' || target END AS "replyToAuthorChannelId",
         text, ts + to_months(CAST(doc_id % 18 AS INTEGER)) AS "publishedAt",
         {clean("text")} AS "textClean", doc_id AS ord
  FROM docev JOIN tops USING (lang, source, week)
)"""

EVENTS = """
ev AS (
  SELECT event_id, event_type, 'u' || user_id AS author, ts, date_trunc('hour', ts) AS hour FROM events
),
evtops AS (
  SELECT event_type, hour, event_id AS top, author AS target FROM ev
  QUALIFY row_number() OVER (PARTITION BY event_type, hour ORDER BY ts, event_id) = 1
),
revents AS (
  SELECT event_type AS "gameLabel", CAST(event_id AS VARCHAR) AS "commentId",
         event_type || '/' || strftime(hour, '%Y-%m-%d %H') AS "threadId",
         event_id = top AS "isTopLevel", author AS "authorChannelId",
         CASE WHEN event_id <> top THEN CAST(top AS VARCHAR) END AS "parentCommentId",
         CASE WHEN event_id <> top THEN target END AS "replyToAuthorChannelId",
         ts AS "publishedAt", event_id AS ord
  FROM ev JOIN evtops USING (event_type, hour)
)"""


def edges(rows: str) -> str:
    return f"""
edges AS (
  SELECT "gameLabel", "authorChannelId" AS source, "replyToAuthorChannelId" AS target, count(*) AS weight
  FROM {rows} WHERE NOT "isTopLevel" AND "authorChannelId" <> "replyToAuthorChannelId" GROUP BY ALL
)"""


GRAPH = """
verts AS (
  SELECT "gameLabel" AS game, source AS node FROM edges UNION SELECT "gameLabel", target FROM edges
),
listed AS (
  SELECT "gameLabel" AS game, source, target, weight,
         row_number() OVER (PARTITION BY "gameLabel" ORDER BY weight DESC, source, target) AS seq FROM edges
),
places AS (
  SELECT game, node, min(place) AS place FROM (
    SELECT game, source AS node, 2 * seq AS place FROM listed
    UNION ALL SELECT game, target, 2 * seq + 1 FROM listed) GROUP BY ALL
),
links AS (
  SELECT l.game, least(l.source, l.target) AS u, greatest(l.source, l.target) AS v,
         arg_max(l.weight, p.place) AS weight
  FROM listed l JOIN places p ON p.game = l.game AND p.node = l.source GROUP BY ALL
),
both_ways AS (
  SELECT game, u AS src, v AS dst, weight FROM links UNION ALL SELECT game, v, u, weight FROM links
),
wdeg AS (
  SELECT game, node, CAST(sum(i) + sum(o) AS BIGINT) AS weighted_degree,
         CAST(sum(i) AS BIGINT) AS in_degree, CAST(sum(o) AS BIGINT) AS out_degree
  FROM (SELECT "gameLabel" AS game, source AS node, 0 AS i, weight AS o FROM edges
        UNION ALL SELECT "gameLabel", target, weight, 0 FROM edges) GROUP BY ALL
),
udeg AS (
  SELECT game, src AS node, count(*) AS degree, sum(weight) AS strength FROM both_ways GROUP BY ALL
)"""

# A partition as input of the measures that take any.
PART = """
part AS (
  SELECT game, node, CAST(CAST(substr(node, 2) AS BIGINT) % 7 AS INTEGER) AS community FROM verts
)"""

LEXICON = f"""
lex AS (SELECT * FROM (VALUES {values(TEST_LEXICON.words.items())}) AS t(term, valence)),
boost AS (SELECT * FROM (VALUES {values(TEST_LEXICON.boosters.items())}) AS t(term, boost)),
negs AS (SELECT * FROM (VALUES {values((w, "true") for w in TEST_LEXICON.negations)}) AS t(term, neg)),
phrases AS (
  SELECT term, len(string_split(term, ' ')) AS n, valence, boost, neg IS NOT NULL AS neg
  FROM lex FULL JOIN boost USING (term) FULL JOIN negs USING (term) WHERE contains(term, ' '))"""

_EDGES = "|".join("".join("\\" + c if c in ".?-" else c for c in p) for p in
                  sorted(X.EDGE_PUNCTUATION, key=len, reverse=True)).replace("'", "''")


def _step(n: int, before: str) -> str:
    """Valence after looking at the word ``n`` places back."""
    so = {d: f"coalesce(l{d} IN ('so', 'this'), false)" for d in (1, 2)}
    never = {1: "false", 2: f"l2 = 'never' AND {so[1]}", 3: f"l3 = 'never' AND ({so[1]} OR {so[2]})"}[n]
    times = {1: 1.0, 2: X.NEVER_NEAR, 3: X.NEVER_FAR}[n]
    return f"""
  CASE WHEN t{n} IS NOT NULL AND v{n} IS NULL AND NOT i{n} THEN
    ({before} + (coalesce(b{n}, 0) * (CASE WHEN {before} < 0 THEN -1 ELSE 1 END)
      + CASE WHEN mixed AND b{n} IS NOT NULL AND upper(t{n}) = t{n} AND lower(t{n}) <> t{n}
             THEN (CASE WHEN {before} > 0 THEN 1 ELSE -1 END) * {X.CAPITALS} ELSE 0 END) * {X.DAMPING[n - 1]})
    * CASE WHEN {never} THEN {times} WHEN g{n} THEN {X.NEGATION} ELSE 1 END
  ELSE {before} END"""


SCORED = rf"""
{LEXICON.strip()},
tok0 AS (
  SELECT "commentId" AS id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos
  FROM (SELECT "commentId", list_filter(string_split("textClean", ' '), lambda x: length(x) > 1 OR x = '|') AS ws FROM comments)
),
tok AS (
  SELECT id, pos, regexp_replace(regexp_replace(w, '^(?:{_EDGES})([^[:punct:]]{{2,}})$', '\1'),
                                 '^([^[:punct:]]{{2,}})(?:{_EDGES})$', '\1') AS w FROM tok0
),
runs AS (
  SELECT id, pos, lower(w) || ' ' || lead(lower(w), 1) OVER p AS g2, g2 || ' ' || lead(lower(w), 2) OVER p AS g3,
         g3 || ' ' || lead(lower(w), 3) OVER p AS g4
  FROM tok WINDOW p AS (PARTITION BY id ORDER BY pos)
),
longest AS (
  SELECT id, pos, arg_max(term, n) AS term, max(n) AS n FROM (
    SELECT id, pos, unnest([g2, g3, g4]) AS term FROM runs) JOIN phrases USING (term) GROUP BY id, pos
),
chosen AS (
  SELECT id, unnest(list_reduce(list([[pos, n]] ORDER BY pos), lambda a, c:
    CASE WHEN c[1][1] >= a[-1][1] + a[-1][2] THEN list_concat(a, c) ELSE a END)) AS m FROM longest GROUP BY id
),
spots AS (
  SELECT id, pos + j AS pos, CASE WHEN valence IS NOT NULL AND j = 0 THEN valence END AS valence,
         CASE WHEN act THEN boost END AS boost, act AND neg AS neg, NOT act AS inert
  FROM (SELECT c.id, l.pos, p.*, unnest(range(p.n)) AS j, j = CASE WHEN valence IS NULL THEN p.n - 1 ELSE 0 END AS act
        FROM chosen c JOIN longest l ON l.id = c.id AND l.pos = c.m[1] JOIN phrases p USING (term))
),
effects AS (
  SELECT t.id, t.pos, t.w, lower(t.w) AS l0, CASE WHEN m.id IS NULL THEN x.valence ELSE m.valence END AS v0,
         CASE WHEN m.id IS NULL THEN b.boost ELSE m.boost END AS b0,
         CASE WHEN m.id IS NULL THEN n.neg IS NOT NULL OR lower(t.w) LIKE '%n''t%' ELSE m.neg END AS g0,
         coalesce(m.inert, false) AS i0
  FROM tok t LEFT JOIN spots m ON m.id = t.id AND m.pos = t.pos LEFT JOIN lex x ON x.term = lower(t.w)
  LEFT JOIN boost b ON b.term = lower(t.w) LEFT JOIN negs n ON n.term = lower(t.w)
),
near AS (
  SELECT *, {", ".join(f"lag({a}, {k}) OVER p AS {b}{k}" for k in (1, 2, 3) for a, b in (
      ("w", "t"), ("l0", "l"), ("v0", "v"), ("b0", "b"), ("g0", "g"), ("i0", "i")))}
  FROM effects WINDOW p AS (PARTITION BY id ORDER BY pos)
),
per_text AS (
  SELECT id, count(*) AS n, count(*) FILTER (upper(w) = w AND lower(w) <> w) BETWEEN 1 AND count(*) - 1 AS mixed,
         min(pos) FILTER (l0 = 'but') AS but_at FROM near GROUP BY id
),
hits AS (
  SELECT n.*, m.mixed, m.but_at FROM near n JOIN per_text m USING (id) WHERE v0 IS NOT NULL AND b0 IS NULL
),
h0 AS (
  SELECT *, CASE WHEN mixed AND upper(w) = w AND lower(w) <> w
                 THEN v0 + (CASE WHEN v0 > 0 THEN 1 ELSE -1 END) * {X.CAPITALS} ELSE v0 END AS s0 FROM hits
),
h1 AS (SELECT *, {_step(1, "s0")} AS s1 FROM h0),
h2 AS (SELECT *, {_step(2, "s1")} AS s2 FROM h1),
h3 AS (SELECT *, {_step(3, "s2")} AS s3 FROM h2),
valued AS (
  SELECT id, s3 * (CASE WHEN l1 = 'least' AND v1 IS NULL AND NOT i1 AND coalesce(l2 NOT IN ('at', 'very'), true)
                        THEN {X.NEGATION} ELSE 1 END)
            * (CASE WHEN pos < but_at THEN {X.BEFORE_BUT} WHEN pos > but_at THEN {X.AFTER_BUT} ELSE 1 END) AS s FROM h3
),
sums AS (
  SELECT id, sum(s) AS total, sum(CASE WHEN s > 0 THEN s + 1 ELSE 0 END) AS up,
         sum(CASE WHEN s < 0 THEN 1 - s ELSE 0 END) AS down, count(*) FILTER (s <> 0) AS k FROM valued GROUP BY id
),
marks AS (
  SELECT c."commentId" AS id, length("textClean") - length(replace("textClean", '!', '')) AS ex,
         length("textClean") - length(replace("textClean", '?', '')) AS qu FROM comments c
),
amplified AS (
  SELECT m.id, coalesce(n - coalesce(k, 0), 0) AS zero, coalesce(total, 0) AS total, coalesce(up, 0) AS up,
         coalesce(down, 0) AS down, least(ex, {X.MAX_EXCLAMATIONS}) * {X.EXCLAMATION}
         + CASE WHEN qu <= 1 THEN 0 WHEN qu <= 3 THEN qu * {X.QUESTION} ELSE {X.MANY_QUESTIONS} END AS emph
  FROM marks m LEFT JOIN per_text USING (id) LEFT JOIN sums USING (id)
),
final AS (
  SELECT id, zero, total + sign(total) * emph AS total,
         up + CASE WHEN up > down THEN emph ELSE 0 END AS up,
         down + CASE WHEN up < down THEN emph ELSE 0 END AS down FROM amplified
),
shares AS (
  SELECT id AS "commentId",
         CASE WHEN up + down + zero > 0 THEN round(down / (up + down + zero), 3) ELSE 0 END AS vader_neg,
         CASE WHEN up + down + zero > 0 THEN round(zero / (up + down + zero), 3) ELSE 0 END AS vader_neu,
         CASE WHEN up + down + zero > 0 THEN round(up / (up + down + zero), 3) ELSE 0 END AS vader_pos,
         round(total / sqrt(total * total + {X.NORMALISER}), 4) AS vader_compound FROM final
),
scored AS (
  SELECT c.*, vader_neg, vader_neu, vader_pos, vader_compound,
         CASE WHEN vader_compound >= 0.05 THEN 'Positive' WHEN vader_compound <= -0.05 THEN 'Negative'
              ELSE 'Neutral' END AS sentiment_label
  FROM comments c JOIN shares USING ("commentId")
)"""

SECOND = """
second AS (
  SELECT CAST(doc_id AS VARCHAR) AS "commentId",
         CASE WHEN toxic = 1 THEN 'Negative' WHEN quality = 1 THEN 'Positive' ELSE 'Neutral' END AS sentiment_label,
         (50 + doc_id % 50) / 100.0::DOUBLE AS roberta_confidence
  FROM labels
)"""

MERGED = """
merged AS (
  SELECT s."gameLabel", s."commentId", s."videoTitle", s."textClean", s."publishedAt", s.vader_compound,
         s.sentiment_label AS vader, b.sentiment_label AS roberta, b.roberta_confidence,
         s.sentiment_label = b.sentiment_label AS agree,
         strftime(s."publishedAt", '%Y-%m') AS month,
         year(s."publishedAt") || 'Q' || quarter(s."publishedAt") AS quarter
  FROM scored s JOIN second b USING ("commentId")
),
bymodel AS (
  SELECT *, 'VADER' AS model, vader AS sentiment FROM merged
  UNION ALL SELECT *, 'RoBERTa', roberta FROM merged
)"""


def distribution(rows: str, keys: list[str], total: str = "total", label: str = "sentiment_label") -> str:
    by = ", ".join(f'"{k}"' for k in keys)
    counts = ", ".join(f"""count(*) FILTER ({label} = '{x}') AS "{x}\"""" for x in LABELS)
    pct = ", ".join(f"""round(100.0 * "{x}" / {total}, 2)::DOUBLE AS {x.lower()}_pct""" for x in LABELS)
    some = " AND ".join(f'"{k}" IS NOT NULL' for k in keys)
    return f"""SELECT *, {pct} FROM (
  SELECT *, "Positive" + "Neutral" + "Negative" AS {total} FROM (
    SELECT {by}, {counts} FROM {rows} WHERE {some} AND {label} IS NOT NULL GROUP BY {by}))"""
