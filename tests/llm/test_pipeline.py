import pytest
from support import HAVE_TABLES, SF, documents, rows
from test_bpe import by_hand as encoded
from test_decontaminate import by_hand as leaks
from test_lines import by_hand as cut
from test_minhash import by_hand as groups

import corpus_pipeline
from marquee.llm.common import stored

pytestmark = pytest.mark.skipif(not HAVE_TABLES, reason="no test tables")


def pairs(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    stages = dict(corpus_pipeline.STAGES)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}

    good = stored(stages["quality_classifier"](spark, docs, SF), "test")
    assert good.columns == docs.columns
    assert set(pairs(good)) <= set(pairs(docs))
    kept = {r.doc_id for r in good.collect()}
    assert {i for i, q in labels.items() if q == 1} <= kept
    assert len(kept & {i for i, q in labels.items() if q == 0}) <= 0.2 * sum(q == 0 for q in labels.values())

    lined = stored(stages["line_dedup"](spark, good, SF), "test")
    assert lined.columns == docs.columns
    assert pairs(lined) == sorted((i, t) for i, _, _, t in cut(pairs(good)))
    assert all(r.n_chars == len(r.text) for r in lined.collect())

    single = stored(stages["minhash_near_dedup"](spark, lined, SF), "test")
    assert single.columns == docs.columns
    assert {r.doc_id for r in single.collect()} == {i for i, _, _, k in groups(pairs(lined), words=5) if k}

    clean = stored(stages["benchmark_decontamination"](spark, single, SF), "test")
    assert clean.columns == docs.columns
    bad = {r[0] for r in leaks(pairs(single), items)}
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in pairs(single)} - bad

    assert rows(stages["bpe_encoding"](spark, clean, SF)) == encoded(pairs(clean))
    assert rows(corpus_pipeline.run(spark, SF)) == encoded(pairs(clean))


@pytest.mark.parametrize("number", range(5))
def test_empty_and_odd_tables(spark, number):
    name, stage = corpus_pipeline.STAGES[number]
    assert stage(spark, documents(spark, []), SF).collect() == []
    odd = documents(spark, [(None, None), (1, ""), (1, ""), (2, "text " * 30_000), (None, "text")])
    out = stage(spark, odd, SF)
    assert out.count() >= 1
    if number < 4:
        assert out.columns == odd.columns
