"""Odd rows through the pipeline's own stages."""

import corpus_pipeline
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _prose(tag, n=120):
    return " ".join(f"{tag}{i}" for i in range(n))


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", None, len(t or "")) for i, t in rows], SCHEMA)


def test_near_duplicates_keep_one_row_of_each_group(spark, folder):
    near = _prose("a").replace("a50 ", "other ")
    rows = [
        (5, _prose("a")), (3, near), (None, _prose("a")), (3, near),  # a group with ids: its smallest stays, once
        (None, _prose("b")), (None, _prose("b")), (None, _prose("b").replace("b7 ", "c ")),  # one without ids
        (7, _prose("d")), (7, _prose("e")), (None, _prose("f")), (8, None), (9, ""), (None, None), (None, None),
    ]
    kept = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, _docs(spark, rows), folder).select("doc_id", "text").collect()]
    named = sorted(r for r in kept if r[0] is not None and r[1])
    assert named == [(3, near), (7, _prose("d")), (7, _prose("e"))]
    nameless = [t for i, t in kept if i is None and t]
    assert len(nameless) == 2 and _prose("f") in nameless and any(t.startswith("b0 ") for t in nameless)
    assert sorted(str(r) for r in kept if not r[1]) == sorted(str(r) for r in rows if not r[1])  # linked with nothing


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_empty_tables_nulls_and_more_columns(spark, folder, stage):
    build = dict(corpus_pipeline.STAGES)[stage]
    docs = _docs(spark, [(None, None), (1, ""), (2, _prose("x")), (2, _prose("x")), (None, _prose("y"))])
    if stage != "packing":
        assert build(spark, docs, folder).columns == docs.columns
    build(spark, docs, folder).collect()
    more = docs.selectExpr("*", "'z' AS kept", "1 AS score", "'s' AS spans", "2 AS component_id", "3 AS row")
    assert build(spark, more, folder).count() == build(spark, docs, folder).count()
    assert build(spark, docs.limit(0), folder).count() == 0
