from collections import Counter

import pytest

pipeline = pytest.importorskip("corpus_pipeline")
from lexgraph.llm import mixing  # noqa: E402


def test_rows_without_an_id_are_mixed(spark, docs, prose):
    rows = [(i, prose(20, i)) for i in range(60)] + [(None, prose(20 + i % 3, -i)) for i in range(30)] + [(None, prose(20, 0))] * 2 + [(None, None), (None, "")]
    rows += [(7, prose(20, 700)), (7, prose(20, 7)), (8, None)]  # repeated ids, with another text, the same and none
    d = docs(rows, source=lambda i: ("big" if i % 3 else "small") if i is not None else None)
    out = pipeline.mix_sources(spark, d, "").collect()
    want = Counter((r.doc_id, r.source, r.n_tokens, r.epoch) for r in mixing.mix(d, budget=1.0, entropy=0.98, max_epochs=4.0).collect())
    assert Counter((r.doc_id, r.source, r.n_tokens, r.epoch) for r in out) == want
    texts = Counter(rows)
    per = Counter((r.doc_id, r.text, r.epoch) for r in out)
    assert all(n <= texts[i, t] for (i, t, _), n in per.items()) and sum(r.doc_id is None for r in out) > 10
    assert all(len(r.text.split()) == r.n_tokens for r in out)


def test_rows_that_repeat_an_id_are_not_lost(spark, docs, prose):
    d = docs([(1, prose(40, 1)), (1, prose(40, 2)), (1, prose(40, 2)), (2, prose(40, 1)), (3, None), (3, ""), (None, "x"), (None, "x")])
    got = sorted((str(r.doc_id), r.text or "") for r in pipeline.drop_near_duplicates(spark, d, "").collect())
    assert got == sorted([("1", prose(40, 1)), ("1", prose(40, 2)), ("3", ""), ("3", ""), ("None", "x"), ("None", "x")])


def test_empty_tables(spark, docs, tmp_path):
    docs([]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_clashing_names(spark, docs, prose):
    d = docs([(i, prose(30, i)) for i in range(30)]).selectExpr("*", "1 as n_tokens", "2 as epoch", "3 as row", "4 as _id", "5 as n", "6 as gone", "7 as t", "8 as d", "9 as hits")
    for stage in (pipeline.drop_lines, pipeline.drop_near_duplicates):
        assert stage(spark, d, "").columns == d.columns and stage(spark, d, "").count() == 30
    assert pipeline.decontaminate.clean(d, spark.createDataFrame([(1, prose(30, 3))], "item_id bigint, text string")).count() == 29
    mixed = pipeline.mix_sources(spark, d, "")
    assert mixed.count() == 30 and sorted(mixed.columns) == sorted(d.columns)
