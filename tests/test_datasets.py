"""Data sets, patches and cube maps by hand-made cases."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lattica.operators import coords as K
from lattica.operators.datasets import Dataset, image_conditioned, replace_failed


def test_no_replacement_without_loaded_rows(spark):
    def fails(row):
        raise ValueError("no")

    rows = spark.createDataFrame([("a",), ("b",)], "sha256 string")
    loaded = Dataset().load({"x": rows}, fails, "n long")
    assert {r["sha256"]: r["error"] for r in loaded.collect()} == {"a": "ValueError: no", "b": "ValueError: no"}
    assert replace_failed(loaded).count() == 0


def test_empty_sources_and_null_predicates(spark):
    rows = spark.createDataFrame([("a", None, True), ("b", 3, None), ("c", 4, True)], "sha256 string, n int, cond_rendered boolean")
    data = image_conditioned(Dataset().where("n", lambda df: F.col("n") > 1), 3)
    assert [r["sha256"] for r in data.instances({"x": rows, "y": rows.limit(0)}).collect()] == ["c"]
    got = {(r["root"], r["step"]): r["survivors"] for r in data.stats({"x": rows, "y": rows.limit(0)}).collect()}
    assert got == {("x", 0): 3, ("x", 1): 2, ("x", 2): 1, ("y", 0): 0, ("y", 1): 0, ("y", 2): 0}


def test_patch_with_a_gap_is_an_error(spark):
    cells = spark.createDataFrame([(0, 0, 0, z, [1.0]) for z in range(2)], "b int, x int, y int, z int, feats array<double>")
    with pytest.raises(Exception, match="lacks cells"):
        K.patchify(cells, 2).collect()
    with pytest.raises(Exception, match="don't fill blocks"):
        K.unpatchify(cells, 2).collect()
    assert K.patchify(cells.limit(0), 2).count() == 0
