"""Queries that write the driver's tables in every source format and read them back; files go to the shared checkpoint folder."""

from __future__ import annotations

import io
import pickle

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lattica.functions import scalars as S
from lattica.functions.udfs import foreach_row, split_errors
from lattica.operators import catalog as C
from lattica.plans.registry import query, table
from lattica.session import scratch
from lattica.sources import catalogs as R
from lattica.sources import voxel_files as V
from lattica.streaming.incremental import upsert_progress


def _sha(key: str):
    return F.concat(F.lit("k"), F.col(key).cast("string")).alias("sha256")


@query("select 'k' || o_orderkey::varchar as sha256, o_orderpriority as file_identifier, case when o_orderkey % 7 <> 0 and o_orderkey % 11 <> 0 then round(o_totalprice, 2) end as aesthetic_score from orders")
def catalog_csv(spark: SparkSession, sf: str) -> DataFrame:
    """A catalog's CSV through its registered reader; empty and NaN scores are null."""
    score = F.when(F.col("o_orderkey") % 7 == 0, None).when(F.col("o_orderkey") % 11 == 0, float("nan")).otherwise(F.round("o_totalprice", 2))
    path = scratch(spark, "csv")
    table(spark, sf, "orders").select(_sha("o_orderkey"), F.col("o_orderpriority").alias("file_identifier"), score.alias("aesthetic_score")).write.option("header", True).csv(path)
    return R.read_catalog(spark, "csv", path)


def _archived(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select((F.col("conv_id") % 16).alias("g"), (F.col("conv_id") * 100 + F.col("turn")).alias("at"), F.coalesce("text", F.lit("")).cast("binary").alias("content"))
    folder = scratch(spark, kind)
    R.pack_groups(rows, folder, "g", "at", F.format_string("m/%010d.txt", "at"), "content", kind).write.format("noop").mode("overwrite").save()
    return R.read_archives(spark, folder, r"m/.*[02468]\.txt").select(F.element_at(F.split("archive", "/"), -1).alias("archive"), "member", "sha256", F.col("content").cast("string").alias("text"))


_ARCHIVED = "select (conv_id % 16)::varchar || '.{kind}' as archive, printf('m/%010d.txt', conv_id * 100 + turn) as member, sha256(coalesce(text, '')) as sha256, coalesce(text, '') as text from conversations where turn % 2 = 0"


@query(_ARCHIVED.format(kind="tar"))
def tar_members(spark: SparkSession, sf: str) -> DataFrame:
    """Tars packed in order, and some of their members."""
    return _archived(spark, sf, "tar")


@query(_ARCHIVED.format(kind="zip"))
def zip_members(spark: SparkSession, sf: str) -> DataFrame:
    """The same from zip files."""
    return _archived(spark, sf, "zip")


@query("select page_id, array_to_string(string_split(url, '/')[:3], '/') as archive, array_to_string(string_split(url, '/')[4:], '/') as member from pages")
def zip_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Paths that lead into an archive."""
    return table(spark, sf, "pages").select("page_id", S.zip_member(F.col("url"), 3).alias("m")).select("page_id", "m.archive", "m.member")


@query("select o_orderkey as id, case when o_orderkey % 2 = 0 then 1 when o_orderkey % 3 = 0 then 2 else 3 end as round from orders where o_orderkey % 2 = 0 or o_orderkey % 3 = 0 or o_orderkey % 5 = 0")
def retried_fetch(spark: SparkSession, sf: str) -> DataFrame:
    """Three rounds over what is still missing; a round gives every second, third, then fifth key."""
    rounds = iter((1, 2, 3))

    def fetch(left: DataFrame) -> DataFrame:
        n = next(rounds)
        return left.where(F.col("id") % (2, 3, 5)[n - 1] == 0).withColumn("round", F.lit(n))

    return R.fetch_remaining(table(spark, sf, "orders").select(F.col("o_orderkey").alias("id")), "id", fetch)


@query("select s_suppkey::varchar || '.txt' as name, length(s_name)::bigint as length, sha256(s_name) as sha256 from supplier")
def fetched_files(spark: SparkSession, sf: str) -> DataFrame:
    """A file per row from a map with error capture, its checksum, and the listing of what is there."""
    folder = scratch(spark, "files")

    def work(row: dict) -> dict:
        V._write_bytes(f"{folder}/{row['s_suppkey']}.txt", row["s_name"].encode())
        return {"done": True}

    good, bad = split_errors(foreach_row(table(spark, sf, "supplier").select("s_suppkey", "s_name"), work, "done boolean", "s_suppkey"))
    if good.count() == 0 and not bad.isEmpty():
        raise RuntimeError(bad.first()["error"])
    listed = R.existing_outputs(spark, folder, ".txt").select(F.concat("sha256", F.lit(".txt")).alias("name"))
    hashed = R.file_hashes(spark, folder, "*.txt").select(F.element_at(F.split("path", "/"), -1).alias("name"), "length", "sha256")
    return hashed.join(listed, "name", "left_semi")


@query("select p_partkey, case when p_size % 5 <> 0 then round(10 / (p_size % 5), 6) end as q, p_size % 5 = 0 as failed from part where p_size % 7 <> 0")
def row_map_errors(spark: SparkSession, sf: str) -> DataFrame:
    """A row that gives nothing is left out, one that raises keeps its key and error."""

    def work(row: dict) -> dict | None:
        return None if row["p_size"] % 7 == 0 else {"q": round(10 / (row["p_size"] % 5), 6)}

    got = foreach_row(table(spark, sf, "part").select("p_partkey", "p_size"), work, "q double", "p_partkey")
    return got.select("p_partkey", "q", F.col("error").isNotNull().alias("failed"))


def _objects(spark: SparkSession, sf: str) -> DataFrame:
    """Per supplier a fan over its first eight line items."""
    rows = table(spark, sf, "lineitem").select("l_suppkey", F.struct("l_orderkey", "l_linenumber", "l_quantity", (F.round(F.col("l_discount") * 100)).alias("d"), F.round(F.col("l_tax") * 100).alias("t")).alias("r"))
    one = rows.groupBy("l_suppkey").agg(F.slice(F.array_sort(F.collect_list("r")), 1, 8).alias("r"))
    vertices = F.transform("r", lambda x: F.array(x["l_quantity"], x["d"], x["t"]))
    tris = F.transform(F.sequence(F.lit(1), F.size("r") - 2), lambda i: F.array(F.lit(0), i, i + 1))
    return one.where(F.size("r") > 2).select(F.col("l_suppkey").cast("string").alias("asset"), vertices.alias("vertices"), tris.alias("tris"))


_OBJECTS = """
r as (select l_suppkey, l_quantity as x, round(l_discount * 100) as y, round(l_tax * 100) as z, row_number() over (partition by l_suppkey order by l_orderkey, l_linenumber, l_quantity, round(l_discount * 100), round(l_tax * 100)) - 1 as vid, count(*) over (partition by l_suppkey) as n from lineitem),
m as (select l_suppkey, vid, x, y, z, least(n, 8) as n from r where vid < 8 and n > 2)
"""
_MESHES = f"with {_OBJECTS} select l_suppkey::varchar as asset, count(*)::bigint as n_vertices, round(sum(x + 2 * y + 3 * z + vid * x), 4) as checksum, (max(n) - 2)::bigint as n_faces, sum(case when vid between 1 and n - 2 then vid * 7 + (vid + 1) * 11 else 0 end)::bigint as face_sum from m group by 1"


def _summary(rows: DataFrame) -> DataFrame:
    """asset, vertices, tris as one row of figures per asset, in which every place of both lists counts."""
    total = lambda c, f: F.aggregate(F.transform(c, f), F.lit(0.0), lambda a, v: a + v)
    point = lambda p, i: F.get(p, F.lit(0)) + F.get(p, F.lit(1)) * 2 + F.get(p, F.lit(2)) * 3 + F.get(p, F.lit(0)) * i
    face = lambda f: (F.get(f, F.lit(0)) * 3 + F.get(f, F.lit(1)) * 7 + F.get(f, F.lit(2)) * 11).cast("double")
    return rows.select(
        "asset", F.size("vertices").cast("long").alias("n_vertices"), F.round(total("vertices", point), 4).alias("checksum"),
        F.size("tris").cast("long").alias("n_faces"), total("tris", face).cast("long").alias("face_sum"),
    )


def _asset(path: str = "path"):
    return F.regexp_extract(path, r"([^/]+)\.[a-z]+$", 1).alias("asset")


@query(_MESHES)
def ply_meshes(spark: SparkSession, sf: str) -> DataFrame:
    """A binary PLY mesh per supplier, read back."""
    folder = scratch(spark, "meshes")
    rows = _objects(spark, sf).withColumn("quads", F.array().cast("array<array<int>>"))
    V.write_mesh_ply(rows, folder).write.format("noop").mode("overwrite").save()
    return _summary(V.read_meshes(spark, folder).select(_asset(), "vertices", "tris"))


@query(_MESHES)
def ply_text_meshes(spark: SparkSession, sf: str) -> DataFrame:
    """The same as text."""
    folder = scratch(spark, "meshes")
    rows = _objects(spark, sf).withColumn("quads", F.array().cast("array<array<int>>"))
    V.write_mesh_ply(rows, folder, binary=False).write.format("noop").mode("overwrite").save()
    return _summary(V.read_meshes(spark, folder).select(_asset(), "vertices", "tris"))


@query(_MESHES)
def pickled_dumps(spark: SparkSession, sf: str) -> DataFrame:
    """A pickled dump per supplier, read without running any code of it."""
    folder = scratch(spark, "dumps")

    def work(row: dict) -> dict:
        dump = {"objects": [{"vertices": np.array([list(v) for v in row["vertices"]]), "faces": np.array([list(f) for f in row["tris"]]), "mat_ids": [0]}], "materials": []}
        V._write_bytes(f"{folder}/{row['asset']}.pickle", pickle.dumps(dump))
        return {"done": True}

    foreach_row(_objects(spark, sf), work, "done boolean", "asset").write.format("noop").mode("overwrite").save()
    first = F.get("objects", F.lit(0))
    return _summary(R.read_dumps(spark, folder).select(_asset(), first["vertices"].alias("vertices"), first["faces"].alias("tris")))


@query(_MESHES)
def obj_meshes(spark: SparkSession, sf: str) -> DataFrame:
    """Wavefront text."""
    folder = scratch(spark, "obj")

    def work(row: dict) -> dict:
        lines = [f"v {x!r} {y!r} {z!r}" for x, y, z in row["vertices"]] + [f"f {a + 1} {b + 1}/1 {c + 1}/1/1" for a, b, c in row["tris"]]
        V._write_bytes(f"{folder}/{row['asset']}.obj", "\n".join(lines).replace("np.float64(", "").replace(")", "").encode())
        return {"done": True}

    foreach_row(_objects(spark, sf), work, "done boolean", "asset").write.format("noop").mode("overwrite").save()
    return _summary(R.read_obj_meshes(spark, folder).select(_asset(), "vertices", F.col("faces").alias("tris")))


@query(f"with {_OBJECTS} select l_suppkey::varchar as asset, f::int as frame, vid::int as vid, (x + f)::double as x, y::double as y, z::double as z from m, range(2) as t(f)")
def mesh_sequences(spark: SparkSession, sf: str) -> DataFrame:
    """Frames of moving vertices from NPZ files."""
    folder = scratch(spark, "frames")

    def work(row: dict) -> dict:
        out, v = io.BytesIO(), np.array([list(v) for v in row["vertices"]])
        np.savez(out, vertices=np.stack([v + [f, 0, 0] for f in range(2)]).astype(np.float32), faces=np.array([list(f) for f in row["tris"]]))
        V._write_bytes(f"{folder}/{row['asset']}.npz", out.getvalue())
        return {"done": True}

    foreach_row(_objects(spark, sf), work, "done boolean", "asset").write.format("noop").mode("overwrite").save()
    moved, _ = V.read_mesh_sequences(spark, folder)
    return moved.select(_asset(), "frame", "vid", *[F.col(a).cast("double").alias(a) for a in "xyz"])


@query("select (l_linenumber % 2)::varchar as asset, count(distinct (trunc(l_quantity), round(l_discount * 100), round(l_tax * 100)))::bigint as num_voxel, 16 as chunk_size, 'parent' as filter, 'deflate' as compression from lineitem group by 1")
def vxz_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Only the headers of voxel files."""
    from lattica.plans.spatial_queries import voxels

    folder = scratch(spark, "headers")
    rows = voxels(spark, sf).select(F.col("b").cast("string").alias("asset"), "x", "y", "z", F.array((F.col("p") % 256).cast("short")).alias("attr"))
    V.write_voxels(rows, folder, "vxz", [("attr", 1)], chunk_size=16, filter="parent", compression="deflate").write.format("noop").mode("overwrite").save()
    V.register(spark)
    info = spark.read.format("vxz").option("mode", "info").load(folder)
    return info.select(_asset(), "num_voxel", "chunk_size", "filter", "compression")


@query("select case when o_orderkey % 4 = 0 then 'test' else 'train' end as split, printf('data/s%d_static_camera_distance_v3/o%d', o_custkey % 10, o_orderkey) as entry, 's' || (o_custkey % 10)::varchar as shard, 'o' || o_orderkey::varchar as obj from orders")
def annotations(spark: SparkSession, sf: str) -> DataFrame:
    """A JSON object of lists, its entries split into shard and object."""
    path = scratch(spark, "annotations")
    rows = table(spark, sf, "orders").select(F.col("o_orderkey") % 4 == 0, F.format_string("data/s%d_static_camera_distance_v3/o%d", F.col("o_custkey") % 10, "o_orderkey")).toDF("test", "entry")
    rows.agg(F.collect_list(F.when(~F.col("test"), F.col("entry"))).alias("train"), F.collect_list(F.when(F.col("test"), F.col("entry"))).alias("test")).write.json(path)
    return R.read_annotations(spark, path).withColumn("e", C.split_entry(F.col("entry"))).select("split", "entry", "e.shard", "e.obj")


@query("select n_nationkey::int as view_index, (n_nationkey * 10 + 3)::double as m03 from nation where n_nationkey % 3 = 1")
def static_cameras(spark: SparkSession, sf: str) -> DataFrame:
    """Every third camera of a JSON file."""
    path = scratch(spark, "cameras")
    matrix = F.array(*[F.array(*[F.lit(float(i == j)) if j < 3 or i else F.col("n_nationkey") * 10 + 3.0 for j in range(4)]) for i in range(4)])
    camera = table(spark, sf, "nation").select(F.struct(F.col("n_nationkey").alias("view_index"), matrix.alias("camera_c2w")).alias("c"))
    camera.agg(F.struct(F.collect_list("c").alias("static_cameras")).alias("_global")).write.json(path)
    return R.read_static_cameras(spark, path, 3, 1).select("view_index", F.get(F.get("camera_c2w", F.lit(0)), F.lit(3)).alias("m03"))


@query("select (row_number() over (order by s_suppkey) - 1)::int as frame, s_name || '.png' as file_path, (s_suppkey % 7 / 10.0)::double as camera_angle_x, 2.0::double as scale from supplier")
def transforms(spark: SparkSession, sf: str) -> DataFrame:
    """The frames of a view set."""
    path = scratch(spark, "transforms")
    eye = F.array(*[F.array(*[F.lit(float(i == j)) for j in range(4)]) for i in range(4)])
    frame = F.struct("s_suppkey", F.concat("s_name", F.lit(".png")).alias("file_path"), (F.col("s_suppkey") % 7 / 10).alias("camera_angle_x"), eye.alias("transform_matrix"))
    rows = table(spark, sf, "supplier").agg(F.array_sort(F.collect_list(frame)).alias("frames"))
    rows.select(F.lit(2.0).alias("scale"), F.array(*map(F.lit, (0.0, 0.0, 0.0))).alias("offset"), F.array(F.array(F.lit(0.0)), F.array(F.lit(1.0))).alias("aabb"), "frames").write.json(path)
    return R.read_transforms(spark, path).select("frame", "file_path", "camera_angle_x", "scale")


@query("select sha256 from (select 'k' || c_custkey::varchar as sha256 from customer where c_acctbal > 0) union all select unnest(['a', 'b', 'c'])")
def instance_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Sorted ids written a line each and read back, and a list in the text itself."""
    path = scratch(spark, "ids")
    R.write_ids(table(spark, sf, "customer").where("c_acctbal > 0").select(_sha("c_custkey")), path, "sha256")
    return R.read_instances(spark, path).union(R.read_instances(spark, "a, b ,c,"))


@query("select 'k' || p_partkey::varchar as sha256, p_size >= 10 as dual_grid_converted, p_size::bigint as dual_grid_size, (case when p_partkey % 2 = 0 then 256 else 512 end)::varchar as res from part")
def variants(spark: SparkSession, sf: str) -> DataFrame:
    """A table per resolution, the resolution a column."""
    root = scratch(spark, "variants")
    rows = table(spark, sf, "part").select(_sha("p_partkey"), (F.col("p_size") >= 10).alias("dual_grid_converted"), F.col("p_size").cast("long").alias("dual_grid_size"), F.col("p_partkey").alias("k"))
    for i, res in enumerate((256, 512)):
        rows.where(F.col("k") % 2 == i).drop("k").write.parquet(f"{root}/dual_grid_{res}")
    return R.read_variants(spark, root, "dual_grid", "res", C.STAGES["dual_grid"])


_LOG = "select 'u' || user_id::varchar as key, event_type as status, event_id::int as num_frames, case when event_id % 3 = 0 then 'late' end as error, event_id from events"


@query(f"with l as ({_LOG}) select key, max_by(status, event_id) as status, max_by(num_frames, event_id) as num_frames, max_by({{'e': error}}, event_id).e as error from l group by key")
def progress_log(spark: SparkSession, sf: str) -> DataFrame:
    """The last record of each key over the logs of eight ranks, whole; their files are in order."""
    path = scratch(spark, "log")
    R.write_log(_log(spark, sf).repartitionByRange(8, "event_id").sortWithinPartitions("event_id").drop("event_id"), path)
    return R.read_progress(spark, f"{path}/*.json").select("key", "status", "num_frames", "error")


def _log(spark: SparkSession, sf: str) -> DataFrame:
    late = F.when(F.col("event_id") % 3 == 0, "late").alias("error")
    return table(spark, sf, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("key"), F.col("event_type").alias("status"), F.col("event_id").cast("int").alias("num_frames"), late, "event_id")


@query(f"with l as ({_LOG}) select key, max_by(status, event_id) as status, max_by(num_frames, event_id) as num_frames, max_by({{'e': error}}, event_id).e as error from l group by key")
def progress_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same from a stream that resumes, in batches that come out of order."""
    rows = _log(spark, sf)
    source, folder, state = (scratch(spark, n) for n in ("records", "catalog", "state"))
    for part in (2, 0, 1):
        R.write_records(rows.where(F.col("event_id") % 3 == part), source, f"r{part}")
        stream = spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).parquet(f"{source}/new_records")
        upsert_progress(stream, folder, state, order="event_id")
    return R.current_catalog(spark, folder).select("key", "status", "num_frames", "error")


@query("select 'k' || o_orderkey::varchar as sha256, case when o_orderkey % 2 = 0 then true when o_orderkey % 3 = 0 then false end as thumbnailed, case when o_orderkey % 2 = 0 then 'fix' else 'base' end as note from orders")
def record_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Record parts over a catalog, archived once the new version is current."""
    folder = scratch(spark, "catalog")
    rows = table(spark, sf, "orders").select(_sha("o_orderkey"), F.col("o_orderkey").alias("k"))
    R.write_catalog(rows.select("sha256", F.when(F.col("k") % 3 == 0, False).alias("thumbnailed"), F.lit("base").alias("note")), folder, "v0")
    R.write_records(rows.where("k % 2 = 0").select("sha256", F.lit(True).alias("thumbnailed"), F.lit("fix").alias("note")), folder, "run1")
    parts = R.pending_records(spark, folder)
    merged = C.merge_records(R.current_catalog(spark, folder), {p.rpartition("/")[2]: spark.read.parquet(p) for p in parts})
    R.write_catalog(merged, folder, "v1", keep=1)
    R.archive_records(spark, folder, parts, "1")
    if R.pending_records(spark, folder):
        raise RuntimeError("records are left")
    return R.current_catalog(spark, folder)


@query("select p_partkey::varchar || chr(9) || 'size ' || p_size::varchar as line from part where p_size % 9 = 0")
def error_list(spark: SparkSession, sf: str) -> DataFrame:
    """The errors' text sink."""
    path = scratch(spark, "errors")
    rows = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_size") % 9 == 0, F.concat(F.lit("size "), F.col("p_size").cast("string"))).alias("error"))
    R.write_errors(rows, path, "p_partkey")
    return spark.read.schema(T.StructType([T.StructField("line", T.StringType())])).text(path)
