"""The pipeline stage by stage, and every query next to its SQL twin on small tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
import check
import corpus_pipeline
from threadloom.llm import decontaminate, simhash
from threadloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"pipeline"}))
def test_query(spark, name):
    text, _ = check.compare(spark, check.connect(SF), name, SF)
    assert text.startswith(("ok", "rows")), text


def test_registered():
    assert set(QUERIES) <= set(entry.queries())
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline"}) == list(range(1, 11))


def test_stages(ready, odd):
    docs = ready.read.parquet(f"{SF}/documents.parquet").select(*odd.columns[:5]).unionByName(odd.select(*odd.columns[:5]))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "source_mix", "token_ids"]
    steps = dict(corpus_pipeline.STAGES)

    def ids(df):
        return {r[0] for r in df.select("doc_id").collect()}

    clean = steps["language_id"](ready, docs, SF)
    assert clean.columns == docs.columns
    assert clean.filter("text is null or not text rlike '\\\\p{L}'").isEmpty()
    assert clean.count() >= 0.97 * docs.filter("text rlike '\\\\p{L}'").count()

    groups = simhash.near_duplicates(clean)
    single = steps["simhash_near_dedup"](ready, clean, SF)
    assert single.columns == docs.columns
    assert ids(single) == {r[0] for r in groups.select("component_id").distinct().collect()}

    items = ready.read.parquet(f"{SF}/benchmark.parquet")
    hit = ids(decontaminate.contained_items(single, items))
    left = steps["benchmark_decontamination"](ready, single, SF)
    assert hit and ids(left) == ids(single) - hit and left.columns == docs.columns

    mixed = steps["source_mix"](ready, left, SF)
    assert mixed.columns == docs.columns and ids(mixed) <= ids(left)
    rows = steps["token_ids"](ready, mixed, SF).collect()
    assert len(rows) == mixed.count()
    ends = sorted((r["start"], r["start"] + r["n_tokens"]) for r in rows)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    assert corpus_pipeline.STAGES[-1][1](ready, mixed.filter("false"), SF).count() == 0


def test_run(ready):
    assert corpus_pipeline.run(ready, SF).count() > 0
