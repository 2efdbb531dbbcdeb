"""Personal data: against plain Python with the patterns as the contract states them."""

import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from threadloom.llm import pii

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digits(v):
    return re.sub("[^0-9]", "", v)


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return 14 <= len(d) <= 19 and total % 10 == 0


def iban(v):
    v = v.replace(" ", "")
    return 15 <= len(v) <= 34 and int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


VALID = {
    "email": lambda v: True, "ip": lambda v: all(int(p) <= 255 for p in v.split(".")), "card": lambda v: luhn(digits(v)),
    "phone": lambda v: 10 <= len(digits(v)) <= 15, "iban": iban, "ssn": lambda v: True,
}


def plain(text):
    """(base, all) spans as text."""
    text = text or ""
    found = []

    def look(rule, body, base):
        spans = [(m.start(), m.end(), m.group()) for m in re.finditer(rule.plain, body, re.ASCII)]
        for n, (a, b, v) in enumerate(spans):
            near = text_near(body, spans, n)
            score = rule.worth + (pii.RAISE if re.search(pii.nearby(pii.WORDS[rule.kind]), near) else 0)
            score -= pii.LOWER_BY if re.search(pii.nearby(pii.SAMPLE_WORDS), near) else 0
            if VALID[rule.kind](v) and (base or round(score, 2) >= pii.ACCEPT):
                found.append((a, pii.KINDS.index(rule.kind), b, base))
        return spans

    def text_near(body, spans, n):
        left = body[spans[n - 1][1] if n else 0: spans[n][0]]
        right = body[spans[n][1]: spans[n + 1][0] if n + 1 < len(spans) else len(body)]
        return (left[-pii.NEAR:] + " " + right[: pii.NEAR]).translate(LOW)

    for kind, rule in pii.RULES.items():
        spans = look(rule, text, kind in pii.BASE)
        if kind in pii.AGAIN and not all(VALID[kind](v) for _, _, v in spans):
            left = list(text)
            for a, b, v in spans:
                if VALID[kind](v):
                    left[a:b] = pii.MASK * (b - a)
            look(pii.AGAIN[kind], "".join(left), False)
    found.sort()
    names = [(f"{pii.KINDS[k]}:{a}:{b}", base) for a, k, b, base in found]
    return ",".join(s for s, base in names if base), ",".join(s for s, _ in names), Counter(
        s.split(":")[0] for s, base in names if base)


PIECES = [
    "a.b@c.de", "x@y", "@", "é@ü.de", "a@b.c_d@e.f", "A+1%@x-y.z.w.", "1.2.3.4", "255.255.255.255", "256.1.1.1", "1.2.3.4.5.6.7.8",
    "0001.002.03.4", "4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1112", "79927398713", "4000000000000000006",
    "+1 (243) 555-5526", "+49 30 1234567", "+1(", "+12", "++1 2", "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000",
    "DE89370400440532013001", "123-45-6789", "SSN", "ssn:", "my card is", "call", "phone", "example", "version", "isbn", " ", "  ",
    "\n", "-", ".", ",", "ß", "😀", "word", "0", "7", "42", "x" * 30, "1" * 25, "e-mail", "İ", "K",
]


def odd_texts():
    rng = random.Random(11)
    return [None, "", "😀 a@b.cd 😀 1.2.3.4", *PIECES] + ["".join(
        rng.choice(PIECES) + rng.choice(["", " ", " ", "  "]) for _ in range(rng.randrange(2, 14))) for _ in range(1500)]


def test_personal_data(ready):
    texts = odd_texts()
    df = ready.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(4)
    got = {r["doc_id"]: r for r in pii.digest(pii.personal_data(df)).collect()}
    assert len(got) == len(texts)
    kinds = Counter()
    for i, text in enumerate(texts):
        base, every, counts = plain(text)
        kinds.update(s.split(":")[0] for s in every.split(",") if s)
        row = got[i]
        assert row["spans"] == every, text
        assert row["base_sha256"] == hashlib.sha256(base.encode()).hexdigest(), text
        assert [row[f"n_{k}"] for k in pii.BASE] == [counts[k] for k in pii.BASE]
    assert set(kinds) == set(pii.KINDS)


def test_second_looks_and_context(ready):
    rows = ["number 4111111111111111 161 77 end", "call +1 (243) 555-5526 1999.99.9", "+1 (243) 555-5526 1999.99.9 is a test",
            "ssn 123-45-6789", "no. 123-45-6789", "IBAN DE89 3704 0044 0532 0130 00 THEN"]
    df = ready.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id int, text string")
    found = {r["doc_id"]: [(s["kind"], s["value"], s["base"]) for s in r["pii"]] for r in pii.personal_data(df).collect()}
    assert found == {0: [("card", "4111111111111111", False)], 1: [("phone", "+1 (243) 555-5526", False)], 2: [],
                     3: [("ssn", "123-45-6789", False)], 4: [], 5: [("iban", "DE89 3704 0044 0532 0130 00", False)]}


def test_long_texts_and_many_matches(ready):
    """Sizes at which a search that starts anew at every character would not end; the results follow from the texts."""
    nothing = ["x" * 2_000_000, "1 " * 300_000, "+" * 100_000, "a@" * 100_000, "9" * 300_000, "+1 (((" * 50_000]
    many = {"a@b.cc ": ("email", 20_000), "1.1.1.1 ": ("ip", 20_000), "1.": ("ip", 50_000), "4111111111111111x": ("card", 9_000)}
    texts = [*nothing, *[piece * (4 * n if piece == "1." else n) for piece, (_, n) in many.items()], "a@b" + ".c" * 200_000]
    df = ready.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string").repartition(5)
    got = {r["doc_id"]: r for r in pii.digest(pii.personal_data(df)).collect()}
    assert all(got[i]["spans"] == "" for i in range(len(nothing)))
    for i, (piece, (kind, n)) in enumerate(many.items(), len(nothing)):
        step, size = (8, 7) if piece == "1." else (len(piece), len(piece) - 1)
        assert got[i][f"n_{kind}"] == n
        assert got[i]["spans"] == ",".join(f"{kind}:{k * step}:{k * step + size}" for k in range(n))
    assert got[len(texts) - 1]["spans"] == "email:0:400003"


def test_rows_columns_and_empty(odd, none):
    found = pii.personal_data(odd.withColumn("pii", F.lit("old")).withColumn("text_hits", F.lit(1)))
    assert found.columns == [*odd.columns, "text_hits", "pii"] and found.count() == odd.count()
    kept = Counter(tuple(r) for r in found.select("doc_id", "text", "lang", "source", "n_chars").collect())
    assert kept == Counter(tuple(r)[:5] for r in odd.collect())
    assert pii.digest(pii.personal_data(none)).count() == 0
