"""Readers of catalogs, archives, logs and cameras, and writers of records. All declare their schemas."""

from __future__ import annotations

import io
import json
import pickle
import re
import tarfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lattica.operators.catalog import STAGES, last_writer, without
from lattica.session import checkpoint, ship

_REGISTRY: dict[str, Callable[..., DataFrame]] = {}


def connector(name: str) -> Callable:
    """Register a catalog reader (spark, path, **options) under a name."""

    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        _REGISTRY[name] = f
        return f

    return add


def read_catalog(spark: SparkSession, name: str, path: str, **options) -> DataFrame:
    """The catalog of a registered connector; an unknown name is an error that lists the known ones."""
    if name not in _REGISTRY:
        raise ValueError(f"unknown connector {name}; known: {', '.join(sorted(_REGISTRY))}")
    return _REGISTRY[name](spark, path, **options)


@connector("csv")
def read_stage(spark: SparkSession, path: str, stage: str = "metadata", schema: T.StructType | None = None) -> DataFrame:
    """A stage's CSV under its declared schema; NaN in a double column becomes null."""
    kind = schema or STAGES[stage]
    df = spark.read.schema(kind).option("header", True).csv(path)
    return nan_to_null(df)


@connector("parquet")
def read_stage_parquet(spark: SparkSession, path: str, **_) -> DataFrame:
    return nan_to_null(spark.read.parquet(path))


def nan_to_null(df: DataFrame) -> DataFrame:
    cells = {f.name: F.when(~F.isnan(f.name), F.col(f.name)) for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(cells) if cells else df


def read_instances(spark: SparkSession, given: str, key: str = "sha256") -> DataFrame:
    """Keys from a text file, a line each, if there is such a path; else from a comma-separated list."""
    try:
        rows = spark.read.text(given).select(F.trim("value").alias(key))
    except Exception as e:  # noqa: BLE001  Spark has one exception type for a missing path
        if "PATH_NOT_FOUND" not in str(e):
            raise
        rows = spark.createDataFrame([(x.strip(),) for x in given.split(",")], f"{key} string")
    return rows.where(F.col(key) != "")


def existing_outputs(spark: SparkSession, folder: str, suffix: str, key: str = "sha256") -> DataFrame:
    """Keys that have an output file {key}{suffix}; only names are read, no contents."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", True).load(folder)
    return files.select(F.regexp_replace(F.element_at(F.split("path", "/"), -1), f"{re.escape(suffix)}$", "").alias(key)).distinct()


def file_hashes(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, length, sha256) of files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def _members(file, name: str) -> Iterator[tuple[str, Callable[[], bytes]]]:
    """Names of an archive's members and how to read each; the archive is read in place, member by member."""
    if name.endswith(".zip"):
        with zipfile.ZipFile(file) as z:
            for info in z.infolist():
                if not info.is_dir():
                    yield info.filename, lambda info=info: z.read(info)
    else:
        with tarfile.open(fileobj=file) as t:
            for info in t:
                if info.isfile():
                    yield info.name, lambda info=info: t.extractfile(info).read()


def read_archives(spark: SparkSession, folder: str, member: str = ".*", pattern: str = "*.{zip,tar,tar.gz,tgz}") -> DataFrame:
    """(archive, member, content, sha256) of the members of zip and tar files whose whole name matches the expression. Archives
    may be of any size: each is opened where it lies, and one member at a time is in memory."""
    from lattica.sources.voxel_files import _open

    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder).select("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, local = _open(path)
                with system.open_input_file(local) as file:
                    for name, read in _members(file, path):
                        if re.fullmatch(member, name):
                            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([name]), pa.array([read()], pa.binary())], names=["archive", "member", "content"])

    return files.mapInArrow(run, "archive string, member string, content binary").withColumn("sha256", F.sha2("content", 256))


class _PlainUnpickler(pickle.Unpickler):
    """Plain containers and NumPy arrays only: a dump can't name any other code."""

    def find_class(self, module: str, name: str):
        if (module.split(".")[0], name) in {("numpy", "ndarray"), ("numpy", "dtype"), ("numpy", "_reconstruct"), ("numpy", "scalar"), ("numpy", "_frombuffer")}:
            return super().find_class(module, name)
        raise pickle.UnpicklingError(f"{module}.{name} isn't allowed in a dump")


DUMP = "objects array<struct<vertices:array<array<double>>,faces:array<array<int>>,mat_ids:array<int>>>, materials array<string>"


def read_dumps(spark: SparkSession, folder: str, pattern: str = "*.pickle") -> DataFrame:
    """(path, objects, materials, error) of pickled mesh dumps; materials as JSON text without their images, and null objects
    with an error for a file that can't be read."""
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder).select("path", "content")
    kinds = {f.name: f.dataType for f in T._parse_datatype_string(DUMP).fields}

    def plain(x):
        return x.tolist() if hasattr(x, "tolist") else list(x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        for batch in batches:
            objects, materials, errors = [], [], []
            for data in batch.column("content").to_pylist():
                try:
                    dump = _PlainUnpickler(io.BytesIO(data)).load()
                    objects.append([{"vertices": plain(o["vertices"]), "faces": plain(o["faces"]), "mat_ids": plain(o.get("mat_ids", []))} for o in dump["objects"]])
                    materials.append([json.dumps({k: v for k, v in m.items() if not isinstance(v, (bytes, dict))}, default=plain) for m in dump.get("materials", [])])
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  a bad file is a result
                    objects.append(None)
                    materials.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            columns = [batch.column("path"), pa.array(objects, to_arrow_type(kinds["objects"])), pa.array(materials, to_arrow_type(kinds["materials"])), pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "objects", "materials", "error"])

    return files.mapInArrow(run, f"path string, {DUMP}, error string")


def read_obj_meshes(spark: SparkSession, folder: str) -> DataFrame:
    """(path, vertices, faces) of Wavefront OBJ text, without Python: v and f lines, faces of any size, indices from 0."""
    lines = spark.read.text(folder, wholetext=True, pathGlobFilter="*.obj").select(F.input_file_name().alias("path"), F.split("value", r"\r?\n").alias("lines"))
    words = lambda kind: F.transform(F.filter("lines", lambda x: x.startswith(f"{kind} ")), lambda x: F.filter(F.slice(F.split(F.trim(x), r"\s+"), 2, 1 << 20), lambda w: w != ""))
    vertices = F.transform(words("v"), lambda w: F.transform(F.slice(w, 1, 3), lambda n: n.cast("double")))
    index = lambda n: F.split_part(n, F.lit("/"), F.lit(1)).cast("int")
    faces = F.transform(words("f"), lambda w: F.transform(w, lambda n: F.when(index(n) > 0, index(n) - 1).otherwise(F.size(vertices) + index(n))))
    return lines.select("path", vertices.alias("vertices"), faces.alias("faces"))


def read_variants(spark: SparkSession, root: str, prefix: str, name: str, schema: T.StructType) -> DataFrame:
    """The tables in folders {prefix}_{value} below root as one, with the value as the column `name`."""
    _, path, system = _fs(spark, root)
    found = sorted(s.getPath().getName() for s in system.listStatus(path) if s.isDirectory() and s.getPath().getName().startswith(f"{prefix}_"))
    out = spark.createDataFrame([], schema).withColumn(name, F.lit(None).cast("string"))
    for folder in found:
        out = out.unionByName(spark.read.schema(schema).parquet(f"{root}/{folder}").withColumn(name, F.lit(folder.removeprefix(f"{prefix}_"))))
    return out


def read_annotations(spark: SparkSession, path: str, splits: Sequence[str] = ("train", "test")) -> DataFrame:
    """(split, entry) of a JSON object of lists."""
    schema = T.StructType([T.StructField(s, T.ArrayType(T.StringType())) for s in splits])
    rows = spark.read.schema(schema).option("multiLine", True).json(path)
    return rows.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, splits)), F.array(*[F.coalesce(s, F.array().cast("array<string>")) for s in splits])))).select(
        F.col("key").alias("split"), F.explode("value").alias("entry")
    )


MATRIX = T.ArrayType(T.ArrayType(T.DoubleType()))


def read_static_cameras(spark: SparkSession, path: str, stride: int = 1, start: int = 0) -> DataFrame:
    """(view_index, camera_c2w) of every stride-th view from `start`."""
    camera = T.StructType([T.StructField("view_index", T.IntegerType()), T.StructField("camera_c2w", MATRIX)])
    schema = T.StructType([T.StructField("_global", T.StructType([T.StructField("static_cameras", T.ArrayType(camera))]))])
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("_global.static_cameras").alias("c")).select("c.*")
    return rows.where(F.pmod("view_index", F.lit(stride)) == start)


def read_transforms(spark: SparkSession, path: str) -> DataFrame:
    """(source, aabb, scale, offset, frame, file_path, camera_angle_x, transform_matrix), a row per frame."""
    frame = T.StructType([T.StructField("file_path", T.StringType()), T.StructField("camera_angle_x", T.DoubleType()), T.StructField("transform_matrix", MATRIX)])
    schema = T.StructType([T.StructField("aabb", MATRIX), T.StructField("scale", T.DoubleType()), T.StructField("offset", T.ArrayType(T.DoubleType())), T.StructField("frames", T.ArrayType(frame))])
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.input_file_name().alias("source"), "aabb", "scale", "offset", F.posexplode("frames").alias("frame", "f"))
    return rows.select("source", "aabb", "scale", "offset", "frame", "f.*")


PROGRESS = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("status", T.StringType()), T.StructField("num_frames", T.IntegerType()), T.StructField("num_faces", T.IntegerType()),
    T.StructField("t_read", T.DoubleType()), T.StructField("t_compute", T.DoubleType()), T.StructField("t_write", T.DoubleType()), T.StructField("error", T.StringType()),
])


def _progress_lines(spark: SparkSession, glob: str) -> DataFrame:
    bad = T.StructField("__bad", T.StringType())
    return spark.read.schema(T.StructType([*PROGRESS.fields, bad])).option("columnNameOfCorruptRecord", "__bad").json(glob)


def read_progress(spark: SparkSession, glob: str) -> DataFrame:
    """The last record of each key, whole, over the logs of all ranks (JSON lines): a later file name wins, and in one file a
    later line. Unreadable lines are left out; progress_errors has them."""
    rows = _progress_lines(spark, glob).withColumns({"__file": F.col("_metadata.file_path"), "__block": F.col("_metadata.file_block_start")})
    place = F.struct("__file", "__block", F.monotonically_increasing_id())  # in a block, ids follow the lines
    rows = rows.withColumn("__place", place).where(F.col("__bad").isNull() & F.col("key").isNotNull())
    return last_writer(rows.drop("__bad", "__file", "__block"), "key", "__place").drop("__place")


def progress_errors(spark: SparkSession, glob: str) -> DataFrame:
    """(source, line) of the log lines that can't be read or have no key."""
    rows = _progress_lines(spark, glob).select("key", "__bad", F.col("_metadata.file_path").alias("source"))
    return checkpoint(rows.where(F.col("__bad").isNotNull() | F.col("key").isNull())).select("source", F.col("__bad").alias("line"))


def fetch_remaining(wanted: DataFrame, key: str, fetch: Callable[[DataFrame], DataFrame], retries: int = 3) -> DataFrame:
    """Fetched rows (key, ...) after up to `retries` rounds over what is still missing; each round is one distributed map, and
    its rows are written down, so that a source is asked once a round and what was seen is what is returned."""
    got = None
    for _ in range(retries):
        left = checkpoint(wanted if got is None else without(wanted, got, key))
        if left.isEmpty():
            break
        found = checkpoint(fetch(left))
        got = found if got is None else got.unionByName(found)
    return got if got is not None else fetch(wanted.limit(0))


# --- sinks ----------------------------------------------------------------------------------------------------------


def write_records(df: DataFrame, folder: str, run_id: str) -> None:
    """One delta of records; the same run written again replaces its own part only."""
    df.write.mode("overwrite").parquet(f"{folder}/new_records/run_id={run_id}")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def pending_records(spark: SparkSession, folder: str) -> list[str]:
    """Folders of deltas not yet merged, in name order."""
    _, path, system = _fs(spark, f"{folder}/new_records")
    return sorted(s.getPath().toString() for s in system.listStatus(path)) if system.exists(path) else []


def archive_records(spark: SparkSession, folder: str, parts: Sequence[str], stamp: str) -> None:
    """Move merged deltas to merged_records/{stamp}_..., after the new catalog is committed."""
    jvm, target, system = _fs(spark, f"{folder}/merged_records")
    system.mkdirs(target)
    for part in parts:
        system.rename(jvm.org.apache.hadoop.fs.Path(part), jvm.org.apache.hadoop.fs.Path(target, f"{stamp}_{part.rstrip('/').rpartition('/')[2]}"))


def write_catalog(df: DataFrame, folder: str, version: str, keep: int | None = None) -> str:
    """Write a new version, then point CURRENT at it by renaming a file over it; readers see the old or the new one, whole. keep:
    how many versions stay, the newest by name; an older one may still have readers, so it's the caller's to say."""
    spark, path = df.sparkSession, f"{folder}/versions/{version}"
    df.write.mode("overwrite").parquet(path)
    jvm, pointer, system = _fs(spark, f"{folder}/CURRENT")
    fresh = jvm.org.apache.hadoop.fs.Path(f"{folder}/CURRENT.{uuid.uuid4().hex}")
    out = system.create(fresh, False)
    out.writeBytes(version)
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.valueOf("OVERWRITE")
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    files.rename(system.makeQualified(fresh), system.makeQualified(pointer), how)
    if keep is not None:
        _, versions, system = _fs(spark, f"{folder}/versions")
        older = sorted(s.getPath().getName() for s in system.listStatus(versions) if s.getPath().getName() <= version)[:-keep]
        for name in older:
            system.delete(jvm.org.apache.hadoop.fs.Path(f"{folder}/versions/{name}"), True)
    return path


def current_catalog(spark: SparkSession, folder: str) -> DataFrame | None:
    _, pointer, system = _fs(spark, f"{folder}/CURRENT")
    if not system.exists(pointer):
        return None
    version = spark.read.text(f"{folder}/CURRENT").first()[0]
    return spark.read.parquet(f"{folder}/versions/{version}")


def write_errors(df: DataFrame, path: str, key: str = "sha256", error: str = "error") -> None:
    df.where(F.col(error).isNotNull()).select(F.concat_ws("\t", F.col(key).cast("string"), error).alias("value")).write.mode("overwrite").text(path)


def write_ids(df: DataFrame, path: str, key: str) -> None:
    """Sorted ids, one a line; a range sort, so the part files are in order."""
    df.select(F.col(key).cast("string").alias("value")).distinct().orderBy("value").write.mode("overwrite").text(path)


def write_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def pack_groups(df: DataFrame, folder: str, group: str, order: str, name: Column, content: str, kind: str = "tar") -> DataFrame:
    """One tar (or zip) per group, its members in order; returns (group, path, members). A group is one object's frames."""
    from lattica.sources.voxel_files import _write_bytes

    if kind not in ("tar", "zip"):
        raise ValueError(f"unknown archive kind: {kind}")
    ship(df.sparkSession)
    rows = df.select(F.col(group).cast("string").alias("group"), F.col(order).alias("at"), name.alias("name"), F.col(content).alias("content"))

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("at")
        out = io.BytesIO()
        members = zip(rows.column("name").to_pylist(), rows.column("content").to_pylist(), strict=True)
        if kind == "zip":
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                for n, data in members:
                    z.writestr(zipfile.ZipInfo(n), data)
        else:
            with tarfile.open(fileobj=out, mode="w") as t:
                for n, data in members:
                    info = tarfile.TarInfo(n)
                    info.size = len(data)
                    t.addfile(info, io.BytesIO(data))
        key = rows.column("group")[0].as_py()
        path = f"{folder}/{key}.{kind}"
        _write_bytes(path, out.getvalue())
        return pa.table({"group": [key], "path": [path], "members": pa.array([rows.num_rows], pa.int64())})

    return rows.groupBy("group").applyInArrow(run, "group string, path string, members long")
