"""The pipeline's stages against plain versions of their decisions, each on the stage's own input."""

import pytest
from brute import near_components, words

import corpus_pipeline
from rollcall.llm import quality_rules
from rollcall.llm.decontaminate import find_leaks
from rollcall.session import materialize

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(materialize(stage(spark, docs[-1], SF), "test-stage"))
    return docs


def test_stages_keep_the_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "near duplicates", "decontamination", "mixing", "token ids",
    ]
    for docs in stages[1:-1]:
        assert docs.dtypes == stages[0].dtypes
    assert 0 < stages[4].count() and stages[3].count() < stages[2].count() < stages[1].count() < stages[0].count()


def test_quality_stage(spark, stages):
    kept = {r["row"].doc_id for r in quality_rules.judged(stages[0]).filter("kept").select("row").collect()}
    assert {r.doc_id for r in stages[1].collect()} == kept


def test_near_duplicate_stage(stages):
    want = near_components([(r.doc_id, r.text) for r in stages[1].collect()], 5, 80)
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted({c for _, c in want.values()})


def test_decontamination_stage(spark, stages):
    held = {r.doc_id for r in find_leaks(stages[2], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    before, after = ({r.doc_id for r in d.collect()} for d in stages[2:4])
    assert held and after == before - held


def test_mixing_stage(stages):
    before = {r.doc_id: r for r in stages[3].collect()}
    copies: dict[int, int] = {}
    for r in stages[4].collect():
        assert r == before[r.doc_id]
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert max(copies.values()) <= 3
    taken: dict[str, list[int]] = {}
    for i, r in before.items():
        n = len(words(r.text))
        had, got, largest = taken.get(r.source, [0, 0, 0])
        taken[r.source] = [had + n, got + n * copies.get(i, 0), max(largest, n)]
    sources = sorted(taken)
    weight = {s: k % 3 + 1 for k, s in enumerate(sources)}
    total = sum(had for had, _, _ in taken.values())
    target, open_sources, left = {}, set(sources), total
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_sources) for s in open_sources}
        over = {s for s in open_sources if share[s] > 3 * taken[s][0]}
        target |= share
        if not over:
            break
        for s in over:
            target[s] = 3 * taken[s][0]
            left -= target[s]
        open_sources -= over
    for s in sources:
        assert abs(taken[s][1] - target[s]) <= taken[s][2] / 2 + 1


def test_token_stage_keeps_the_training_order(spark, stages):
    order = corpus_pipeline.stored_order(stages[4])
    rows = [r.doc_id for r in stages[4].orderBy(*order).select("doc_id").collect()]
    told = sorted(stages[5].collect(), key=lambda r: r.start)
    assert [r.doc_id for r in told] == rows
    at = 0
    for r in told:
        assert r.start == at
        at += r.n_tokens


def test_odd_tables(spark):
    text = " ".join(f"w{k} the of" for k in range(40))
    rows = [(1, text, "xx", None, 1, "a"), (None, text, None, "s", 2, "b"), (3, None, None, None, None, None), (4, "", "en", "", 0, "")]
    df = spark.createDataFrame(rows * 2, "doc_id long, text string, lang string, source string, n_chars long, row string")
    for table in (df, df.limit(0)):
        docs = table
        for _, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, SF), "test-odd")
            docs.count()
        assert docs.count() == (1 if table is df else 0)
