import numpy as np
import pyarrow as pa
import pytest

common = pytest.importorskip("lexgraph.llm.common")


def test_hashes_depend_on_the_words_alone():
    texts = ["Ab  cd", "cd\tAB", "", None, "ab\ncd ", "x" * 3_000_000 + " cd"]
    h, start, end, first = common.word_hashes(*common.text_buffers(pa.array(texts)))
    got = [h[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
    assert got[0] == got[1][::-1] == got[4] and got[2] == got[3] == [] and got[5][1] == got[0][1] and len(got[5]) == 2
    assert len(set(h.tolist())) == 3
    assert (end > start).all()


def test_sliced_columns():
    t = pa.array(["one", "two three", None, "four"]).slice(1, 3)
    h, _, _, first = common.word_hashes(*common.text_buffers(t))
    assert np.diff(first).tolist() == [2, 0, 1]


def test_components(spark):
    e = spark.createDataFrame([(5, 4), (4, 3), (3, 9), (10, 11), (7, 7), (None, 2), (100, 11)], "a bigint, b bigint")
    got = {r.node: r.component for r in common.components(e).collect()}
    assert got == {3: 3, 4: 3, 5: 3, 9: 3, 10: 10, 11: 10, 100: 10}
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)], "a bigint, b bigint")
    assert {r.component for r in common.components(chain).collect()} == {0}
    assert common.components(e.limit(0)).count() == 0
