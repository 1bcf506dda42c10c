"""Every registered query with SQL gives DuckDB's rows; the others give rows with a stable schema."""

from __future__ import annotations

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from compare import same

from lattica.plans import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_same_as_sql(spark, sf, name):
    same(registry.QUERIES[name](spark, sf), registry.ORACLES[name], sf)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(spark, sf, name):
    df = registry.QUERIES[name](spark, sf)
    assert df.count() > 0
    assert registry.QUERIES[name](spark, sf).schema == df.schema


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 7
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", ["channel_functions", "channels_in_rows", "channel_folds", "segment_group_norm"])
def test_channels_equal_their_sql_in_type_last_digit_and_sign(spark, tmp_path, name):
    """Thousandths and a half, where single and double precision round apart, and values that round to -0.0."""
    halves = [[(64 * i + k + 0.5) / 1000 * (-1) ** k for k in range(64)] for i in range(30)]
    small = [[1.0, -1.0, 0.0, -1e-8] * 16, [-1e-8, 1.0, -1.0, 0.0] * 16]
    e = np.array(halves + small, np.float32)
    labels = [0] * len(halves) + [1] * len(small)
    columns = {"vec_id": pa.array(range(len(e)), pa.int64()), "embedding": pa.array(list(e), pa.list_(pa.float32())), "label": pa.array(labels, pa.int32())}
    pq.write_table(pa.table(columns), tmp_path / "embeddings.parquet")
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet'")
    want = con.sql(registry.ORACLES[name]).to_arrow_table()
    got = registry.QUERIES[name](spark, str(tmp_path)).toArrow().select(want.column_names)
    assert sorted(map(repr, got.to_pylist())) == sorted(map(repr, want.to_pylist()))
