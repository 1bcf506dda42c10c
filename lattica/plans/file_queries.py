"""Queries that pass through the engine's own files and streams; scratch files go to the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.plans.catalog_queries import LAYERS, _layers
from lattica.plans.registry import query
from lattica.plans.spatial_queries import VOXELS, voxels
from lattica.session import scratch
from lattica.sources import voxel_files as V
from lattica.sources.catalogs import current_catalog
from lattica.streaming.incremental import merge_stream

_BYTES = f"with {VOXELS} select b, x, y, z, (p % 256)::int as v, (n % 256)::int as n from v"


def _through(spark: SparkSession, sf: str, kind: str, **options) -> DataFrame:
    """All voxels (b, x, y, z, v, n) through one file per batch."""
    rows = voxels(spark, sf).select(F.col("b").cast("string").alias("asset"), "x", "y", "z", F.array((F.col("p") % 256).cast("short"), (F.col("n") % 256).cast("short")).alias("attr"))
    out = None
    for file in V.write_voxels(rows, scratch(spark, kind), kind, [("attr", 2)], **options).collect():
        got = V.read_voxels(spark, file["path"], ["attr"])
        got = got.select(F.lit(int(file["asset"])).alias("b"), "x", "y", "z", F.get("attr", F.lit(0)).cast("int").alias("v"), F.get("attr", F.lit(1)).cast("int").alias("n"))
        out = got if out is None else out.unionByName(got)
    return out


@query(_BYTES)
def vxz_parent_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Written in chunks and read back."""
    return _through(spark, sf, "vxz", chunk_size=16, filter="parent", compression="zstd", level=3)


@query(_BYTES)
def vxz_neighbour_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _through(spark, sf, "vxz", chunk_size=32, filter="neighbor", compression="deflate", interleave="none")


@query(f"with {VOXELS} select b, x, y, z, (p % 256)::int as v, (n % 256)::int as n from v where x >= 32 and y < 8")
def vxz_box(spark: SparkSession, sf: str) -> DataFrame:
    """A box filter that skips chunks."""
    return _through(spark, sf, "vxz", chunk_size=8, compression="none").where("x >= 32 and y < 8")


@query(_BYTES)
def npz_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """K5, S10."""
    return _through(spark, sf, "npz")


@query(_BYTES)
def ply_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """K6, S13."""
    return _through(spark, sf, "ply")


@query(f"with {LAYERS} select key, coalesce(f.status, b.status) as status, coalesce(f.cust, b.cust) as cust from base b full join fixes f using (key)")
def stream_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Record parts consumed once each by a stream, laid over the catalog."""
    base, _, fixes = _layers(spark, sf)
    parts, folder, state = (scratch(spark, n) for n in ("parts", "catalog", "state"))
    for name, df in (("part_0", base), ("part_1", fixes)):
        df.write.parquet(f"{parts}/{name}")
        merge_stream(spark, parts, df.schema, folder, state, key="key")
    return current_catalog(spark, folder)
