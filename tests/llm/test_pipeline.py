import pytest
from pyspark.sql import functions as F

pipeline = pytest.importorskip("corpus_pipeline")
from test_text_operators import brute_groups, brute_lines  # noqa: E402


@pytest.fixture()
def corpus(spark, docs, prose, tmp_path):
    passage = prose(30, "bench")
    rows = [(i, "\n".join(prose(14, f"{i} {j}") for j in range(4))) for i in range(160)]
    rows += [(200 + i, prose(20, i) + " idiot moron scum idiot " + prose(10, -i)) for i in range(60)]
    rows += [(300 + i, rows[i][1].replace(" e", " é", 1)) for i in range(10)] + [(320 + i, prose(20, f"x{i}") + " " + passage + " " + prose(10, f"y{i}")) for i in range(8)]
    rows += [(400, None), (401, ""), (None, prose(30, "none")), (402, prose(8, "short")), (403, rows[3][1])]
    d = docs(rows, source=lambda i: "big" if (i or 0) % 3 else "small")
    d.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(200 <= i < 260)) for i, _ in rows if i is not None and i < 260], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_every_stage_against_brute_force(spark, corpus, tmp_path):
    read = lambda p: spark.read.parquet(str(p))
    got, d = [], read(f"{corpus}/documents.parquet")
    columns = d.columns
    for n, (name, stage) in enumerate(pipeline.STAGES):
        stage(spark, d, corpus).write.parquet(str(tmp_path / f"stage{n}"))
        d = read(tmp_path / f"stage{n}")
        got.append([(r.doc_id, r.text) for r in d.collect()])
        assert d.columns[: len(columns)] == columns, name
    start = [(r.doc_id, r.text) for r in read(f"{corpus}/documents.parquet").collect()]
    clean, lines, near, decontaminated, mixed = got
    assert {i for i, _ in start} - {i for i, _ in clean} == set(range(200, 260))
    gone = brute_lines(clean)
    want = {i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone) if t is not None and i is not None else t for i, t in clean}
    assert dict(lines) == want and len(lines) == len(clean)
    groups = brute_groups(lines, 5)
    assert sorted(i for i, _ in near if i is not None) == sorted(i for i, (_, c) in groups.items() if i == c) and sum(i is None for i, _ in near) == 1
    passage = read(f"{corpus}/benchmark.parquet").first().text
    assert {i for i, _ in near} - {i for i, _ in decontaminated} == {i for i, t in near if passage in (t or "")}
    left = dict(decontaminated)
    assert {i for i, _ in mixed} <= set(left) and all(left[i] == t for i, t in mixed) and len(mixed) > 50


def test_run(spark, corpus):
    out = pipeline.run(spark, corpus)
    assert {"doc_id", "text", "epoch"} <= set(out.columns) and out.count() > 50
    assert out.groupBy("doc_id", "epoch").count().where("count > 1").count() == 0
    assert pipeline.ORACLE_SQL is None and F is not None
