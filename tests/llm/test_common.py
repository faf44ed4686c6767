"""Helpers: slices of batches, free names, stored tables."""

import pyarrow as pa
import pytest

from feedloom.llm import common


@pytest.mark.parametrize("lengths", [[], [0], [5] * 10, [100, 1, 1, 100, 1], [1] * 30])
def test_slices_keep_rows_and_stay_small(lengths):
    batch = pa.RecordBatch.from_arrays([pa.array([b"x" * n for n in lengths], pa.binary())], ["t"])
    parts = list(common.slices(batch, "t", rows=7, size=12))
    assert [x for p in parts for x in p.column("t").to_pylist()] == batch.column("t").to_pylist()
    for p in parts:
        total = sum(map(len, p.column("t").to_pylist()))
        assert 0 < p.num_rows <= 7 and (total <= 12 or p.num_rows == 1)
    nulls = pa.RecordBatch.from_arrays([pa.array([None, b"x", None], pa.binary())], ["t"])
    assert sum(p.num_rows for p in common.slices(nulls, "t")) == 3


def test_free_names():
    assert common.free_name("_t", ["a"]) == "_t" and common.free_name("_t", ["_T", "_t_"]) == "_t__"


def test_texts_that_are_null_or_not_utf8():
    assert common.decoded_texts(pa.array([None, b"", b"a\xff"], pa.binary())) == ["", "", "a�"]


def test_written_tables_read_back(spark, rows):
    df = spark.range(5)
    assert rows(common.written(df, "test")) == rows(df)


def test_a_worker_keeps_one_object_of_one_module():
    made = []
    for key in (("a", 1), ("a", 1), ("a", 2), ("b", 1)):
        common.held(key, lambda key=key: made.append(key))
    assert made == [("a", 1), ("a", 2), ("b", 1)] and list(common._held) == [("b", 1)]
    common.release_others("b")
    assert list(common._held) == [("b", 1)]
    common.release_others("a")
    assert not common._held
