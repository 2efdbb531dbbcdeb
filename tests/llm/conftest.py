import random

import pytest

from threadloom.llm.common import prepare

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(rng, n, vocabulary=400):
    return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def ready(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in all columns, empty, blank and long texts, copies, near copies, repeated rows and ids."""
    rng = random.Random(7)
    base = [words(rng, rng.randrange(1, 120)) for _ in range(40)]
    long = "\n".join(words(rng, 12) for _ in range(400))
    line = "A Line That Many Documents Share, With Some Words"
    texts = [*base, *base[:10], None, "", "   \n\t ", "\n\n", long, long + " end", "é", "12 34 !", "x" * 5000,
             *(f"{t}\n {line} \n" for t in base[:6]), *(f"{line.upper()}\n{t}" for t in base[6:9])]
    rows = [(i, t, ["en", "de", None][i % 3], ["s1", "s2", "s3", "s10", None][i % 5], len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (4, "another text under the id four", "en", "s1", 30), (None, base[5], "en", "s2", 1),
             (None, f"{line}\nno id", None, None, None), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def odd(ready, odd_rows):
    """Partitioned, and with extra columns whose names the operators use inside or return."""
    from pyspark.sql import functions as F

    df = ready.createDataFrame(odd_rows, DOC).repartition(5)
    clash = ["fp", "key", "host", "rule", "score", "size", "target", "taken", "hi", "lo", "fingerprint", "_w", "_h", "n",
             "lang_pred", "g", "sid", "weight", "item_id", "best", "_hit", "hit", "row", "page", "rank", "pii", "kind"]
    return df.select("*", *[F.lit(f"extra {c}").alias(c) for c in clash])


@pytest.fixture(scope="session")
def none(ready):
    return ready.createDataFrame([], DOC)
