import pytest
from edge import documents, empty, frame, tokens
from test_near_dedup import brute
from test_text_operators import measured

import corpus_pipeline as p
from cadenza.llm import quality_rules


def test_stages_keep_columns_and_handle_edges(spark):
    docs = frame(spark, clash=True)
    for name, stage in p.STAGES[:-1]:
        got = stage(spark, docs, "")
        assert got.dtypes == docs.dtypes, name
        values = {tuple(r[c] for c in ("score", "lang_pred", "bucket")) for r in got.collect()}
        assert values <= {(7.0, "x", 9)}, name
    assert p.STAGES[-1][1](spark, docs, "").count() == len(documents())


@pytest.mark.parametrize("stage", [s for _, s in p.STAGES])
def test_stages_of_nothing(spark, stage):
    assert stage(spark, empty(spark), "").count() == 0


def test_quality_stage_against_brute_force(spark):
    got = sorted(repr(r.doc_id) for r in p.quality_stage(spark, frame(spark), "").collect())
    ledger = {(r.doc_id, r.text): r.failed for r in quality_rules.ledger(frame(spark)).collect()}
    assert got == sorted(repr(r[0]) for r in documents() if ledger[r[0], r[1]] == 0)
    for r in documents():
        w, _, _, _, repeats = measured(r[1])
        assert bool(ledger[r[0], r[1]] & 3) == (w < 20 or 100 * repeats > 30 * w)


def test_run(spark, tmp_path):
    frame(spark).coalesce(1).write.parquet(f"file://{tmp_path}/documents.parquet")
    got = p.run(spark, f"file://{tmp_path}").collect()
    assert got and {"doc_id", "n_tokens", "bucket", "batch", "slot"} <= set(got[0].asDict())
    kept = p.quality_stage(spark, frame(spark), "")
    kept = p.language_stage(spark, kept, "").collect()
    survivors = {d for d, _, _, k in brute([(r.doc_id, r.text) for r in kept], 5) if k}
    text = {r[0]: r[1] for r in documents()}
    assert sorted((repr(r.doc_id), r.n_tokens) for r in got) == sorted((repr(d), len(tokens(text[d])) + 1) for d in survivors)


def test_languages_that_were_not_learned_go(spark):
    import random

    rng = random.Random(4)
    words = {"a": "ka lo mi ru", "b": "stren glopf wirz", "c": "ééà çèù ôï", "d": "mwz xqv pkj", "unknown": "жуш цын щёт"}
    docs = [(k, " ".join(rng.choices(w.split(), k=40))) for k, w in words.items() for _ in range(30)]
    for learned in ("a", "ab", "abcd"):
        rows = [(i, t, k if k in learned else None) for i, (k, t) in enumerate(docs) if k in learned or k == "unknown"]
        kept = {r.doc_id for r in p.language_stage(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"), "").collect()}
        assert {i for i, _, k in rows if k} <= kept
        if len(learned) > 1:  # one language has no rest to tell it from
            assert kept == {i for i, _, k in rows if k}
