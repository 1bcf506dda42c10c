"""Voxel files: the chunked VXZ container, NPZ and PLY, as Spark data sources and as sinks.

`spark.read.format("vxz")` gives one row per voxel (path, x, y, z, then the attributes named by the `attributes` option, each
an array of smallint). A partition is a file's chunk; filters on x, y and z are pushed down and skip chunks outside the box.
With option mode=info there is one row per file, read from the header alone. `npz` and `ply` have one partition per file.
Paths may be local or of any file system pyarrow knows; executors must be able to open them.
"""

from __future__ import annotations

import io
import json
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from lattica.operators import codecs
from lattica.session import ship

# Fixed values of the container: magic, version, byte order of the header's length.
MAGIC, VERSION, LENGTH = b"VXZ", 0, ">I"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def list_files(paths: str, suffix: str) -> list[str]:
    """Files named, or with the suffix inside the folders named (comma-separated), in order."""
    out = []
    for path in filter(None, paths.split(",")):
        system, local = _open(path)
        info = system.get_file_info(local)
        if info.type == fs.FileType.Directory:
            found = system.get_file_info(fs.FileSelector(local, recursive=True))
            out += sorted(f.path for f in found if f.is_file and f.path.endswith(suffix))
        else:
            out.append(path)
    return out


def read_bytes(path: str, start: int = 0, length: int | None = None) -> bytes:
    system, local = _open(path)
    with system.open_input_file(local) as f:
        return f.read_at(f.size() - start if length is None else length, start)


def read_header(path: str) -> tuple[dict, int]:
    """The header and where the chunks start; reads no chunk."""
    head = read_bytes(path, 0, 8)
    if head[:3] != MAGIC:
        raise ValueError(f"{path} isn't a VXZ file")
    if head[3] != VERSION:
        raise ValueError(f"{path} has version {head[3]}")
    start = struct.unpack(LENGTH, head[4:8])[0]
    return json.loads(read_bytes(path, 8, start - 8)), start


def decode_chunk(raw: bytes, chunk: dict, header: dict) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates (n, 3) and attribute bytes (n, all channels) of a chunk."""
    size, how = header["chunk_size"], header["compression"]
    depth = size.bit_length() - 1
    data = {k: codecs.decompress(raw[v[0] : v[0] + v[1]], how, header["compression_level"]) for k, v in chunk.items() if k not in ("ptr", "idx")}
    codes = codecs.decode_octree(data["svo"], depth)
    place = codecs.unmorton(codes)
    attr = codecs.unstreams(data, header["attr"], header["attr_interleave"])
    if header["filter"] == "parent":
        attr = codecs.parent_unfilter(codes, attr, depth)
    elif header["filter"] == "neighbor":
        attr = codecs.neighbour_unfilter(place, attr)
    elif header["filter"] != "none":
        raise ValueError(f"unknown filter: {header['filter']}")
    return place + np.array(chunk["idx"], np.int32) * size, attr


def encode_chunk(place: np.ndarray, attr: np.ndarray, size: int, layout: Sequence[tuple[str, int]], filter: str, compression: str, level: int | None, interleave: str) -> tuple[dict, bytes]:
    """(stream offsets, bytes) of a chunk; place: coordinates inside it."""
    depth = size.bit_length() - 1
    codes = codecs.morton(place)
    order = np.argsort(codes)
    codes, place, attr = codes[order], place[order], np.ascontiguousarray(attr[order])
    if filter == "parent":
        attr = codecs.parent_filter(codes, attr, depth)
    elif filter == "neighbor":
        attr = codecs.neighbour_filter(place, attr)
    elif filter != "none":
        raise ValueError(f"unknown filter: {filter}")
    info, out = {}, b""
    for name, raw in {"svo": codecs.encode_octree(codes, depth), **codecs.streams(attr, layout, interleave)}.items():
        packed = codecs.compress(raw, compression, level)
        info[name] = [len(out), len(packed)]
        out += packed
    return info, out


def pack_file(chunks: Sequence[tuple[list[int], dict, bytes]], header: dict) -> bytes:
    """A container from encoded chunks (idx, stream offsets, bytes)."""
    at, entries = 0, []
    for idx, info, data in chunks:
        entries.append({"idx": idx, **info, "ptr": [at, len(data)]})
        at += len(data)
    header = header | {"chunks": entries, "compressed_size": at, "compress_ratio": header["raw_size"] / at if at else 0.0}
    text = json.dumps(header).encode()
    return MAGIC + bytes([VERSION]) + struct.pack(LENGTH, len(text) + 8) + text + b"".join(d for _, _, d in chunks)


# --- reading --------------------------------------------------------------------------------------------------------


def _schema(options: dict) -> str:
    names = [n for n in options.get("attributes", "").split(",") if n]
    return "path string, x int, y int, z int" + "".join(f", {n} array<smallint>" for n in names)


@dataclass
class ChunkPartition(InputPartition):
    path: str
    chunk: dict
    header: dict
    start: int


@dataclass
class FilePartition(InputPartition):
    path: str


def _batch(path: str, coord: np.ndarray, attr: dict[str, np.ndarray], schema: T.StructType) -> pa.RecordBatch:
    n = len(coord)
    columns = [pa.array([path] * n, pa.string()), *[pa.array(coord[:, i].astype(np.int32)) for i in range(3)]]
    for f in schema.fields[4:]:
        v = attr[f.name].astype(np.int16)
        offsets = pa.array(np.arange(n + 1, dtype=np.int32) * v.shape[1])
        columns.append(pa.ListArray.from_arrays(offsets, pa.array(v.ravel())))
    return pa.RecordBatch.from_arrays(columns, names=schema.names)


class VxzSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "vxz"

    def schema(self) -> str:
        if self.options.get("mode") == "info":
            return "path string, num_voxel long, chunk_size int, filter string, compression string, compression_level int, raw_size long, compressed_size long, compress_ratio double, attr_interleave string, attr array<struct<name:string,channels:int>>, chunks int"
        return _schema(self.options)

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return VxzInfoReader(self.options) if self.options.get("mode") == "info" else VxzReader(schema, self.options)


class VxzInfoReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [FilePartition(p) for p in list_files(self.options["path"], ".vxz")]

    def read(self, partition: FilePartition) -> Iterator[tuple]:
        h, _ = read_header(partition.path)
        yield (
            partition.path, h["num_voxel"], h["chunk_size"], h["filter"], h["compression"], h["compression_level"], h["raw_size"], h["compressed_size"],
            h["compress_ratio"], h["attr_interleave"], [(n, c) for n, c in h["attr"]], len(h["chunks"]),
        )


class VxzReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self._schema, self.options, self.box = schema, options, {}

    def pushFilters(self, filters):  # noqa: N802
        """Comparisons of x, y and z with numbers choose the chunks; all filters stay, as a chunk holds more than the box."""
        for f in filters:
            column = getattr(f, "attribute", ())
            if len(column) == 1 and column[0] in "xyz" and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                low, high = self.box.get(column[0], (-np.inf, np.inf))
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    low = max(low, f.value)
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    high = min(high, f.value)
                self.box[column[0]] = (low, high)
            yield f

    def partitions(self) -> list[InputPartition]:
        out = []
        for path in list_files(self.options["path"], ".vxz"):
            header, start = read_header(path)
            size, rest = header["chunk_size"], {k: v for k, v in header.items() if k != "chunks"}
            for chunk in header["chunks"]:
                first = dict(zip("xyz", (i * size for i in chunk["idx"]), strict=True))
                if all(lo < first[a] + size and hi >= first[a] for a, (lo, hi) in self.box.items()):
                    out.append(ChunkPartition(path, chunk, rest, start))
        return out

    def read(self, partition: ChunkPartition) -> Iterator[pa.RecordBatch]:
        chunk, header = partition.chunk, partition.header
        coord, attr = decode_chunk(read_bytes(partition.path, partition.start + chunk["ptr"][0], chunk["ptr"][1]), chunk, header)
        parts, at = {}, 0
        for name, n in header["attr"]:
            parts[name] = attr[:, at : at + n]
            at += n
        yield _batch(partition.path, coord, parts, self._schema)


class _FileSource(DataSource):
    suffix = ""

    def schema(self) -> str:
        return _schema(self.options)

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _FileReader(schema, self.options, self.suffix)


class NpzSource(_FileSource):
    suffix = ".npz"

    @classmethod
    def name(cls) -> str:
        return "npz"


class PlySource(_FileSource):
    suffix = ".ply"

    @classmethod
    def name(cls) -> str:
        return "plyvoxel"


class _FileReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict, suffix: str):
        self._schema, self.options, self.suffix = schema, options, suffix

    def partitions(self) -> list[InputPartition]:
        return [FilePartition(p) for p in list_files(self.options["path"], self.suffix)]

    def read(self, partition: FilePartition) -> Iterator[pa.RecordBatch]:
        data = read_bytes(partition.path)
        coord, attr = parse_npz(data) if self.suffix == ".npz" else parse_ply_voxels(data)
        yield _batch(partition.path, coord, attr, self._schema)


def parse_npz(data: bytes) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """`coord` (or `coords`) and every other array of as many rows."""
    with np.load(io.BytesIO(data)) as z:
        coord = z["coord"] if "coord" in z else z["coords"]
        return coord.astype(np.int32), {k: (v if v.ndim > 1 else v[:, None]) for k, v in z.items() if k not in ("coord", "coords") and len(v) == len(coord)}


# Scalar types of PLY headers.
PLY_TYPES = {
    "char": "i1", "uchar": "u1", "short": "i2", "ushort": "u2", "int": "i4", "uint": "u4", "float": "f4", "double": "f8",
    "int8": "i1", "uint8": "u1", "int16": "i2", "uint16": "u2", "int32": "i4", "uint32": "u4", "float32": "f4", "float64": "f8",
}


def parse_ply(data: bytes) -> dict[str, dict[str, np.ndarray | list[np.ndarray]]]:
    """Elements of a PLY file, ASCII or binary: name -> property -> values (list properties: one array per row)."""
    head, _, body = data.partition(b"end_header\n")
    if not _:
        head, _, body = data.partition(b"end_header\r\n")
    lines = [line.split() for line in head.decode().splitlines()]
    if not lines or lines[0] != ["ply"]:
        raise ValueError("not a PLY file")
    form = next(line[1] for line in lines if line[:1] == ["format"])
    elements: list[tuple[str, int, list[list[str]]]] = []
    for line in lines:
        if line[:1] == ["element"]:
            elements.append((line[1], int(line[2]), []))
        elif line[:1] == ["property"]:
            elements[-1][2].append(line[1:])
    out, order = {}, "<" if form == "binary_little_endian" else ">"
    tokens, at = (body.split(), 0) if form == "ascii" else (None, 0)
    for name, n, properties in elements:
        got: dict = {p[-1]: [] for p in properties}
        if not any(p[0] == "list" for p in properties):
            if tokens is not None:
                flat = np.array(tokens[at : at + n * len(properties)], float).reshape(n, len(properties))
                at += n * len(properties)
                got = {p[1]: flat[:, i].astype(PLY_TYPES[p[0]]) for i, p in enumerate(properties)}
            else:
                kind = np.dtype([(p[1], order + PLY_TYPES[p[0]]) for p in properties])
                rows = np.frombuffer(body, kind, n, at)
                at += n * kind.itemsize
                got = {p[1]: rows[p[1]] for p in properties}
        else:
            for _row in range(n):
                for p in properties:
                    if tokens is not None:
                        k = int(tokens[at]) if p[0] == "list" else 1
                        at += p[0] == "list"
                        got[p[-1]].append(np.array(tokens[at : at + k], float).astype(PLY_TYPES[p[-2]]))
                        at += k
                    else:
                        k = 1
                        if p[0] == "list":
                            kind = np.dtype(order + PLY_TYPES[p[1]])
                            k = int(np.frombuffer(body, kind, 1, at)[0])
                            at += kind.itemsize
                        kind = np.dtype(order + PLY_TYPES[p[-2]])
                        got[p[-1]].append(np.frombuffer(body, kind, k, at))
                        at += k * kind.itemsize
        out[name] = got
    return out


def parse_ply_voxels(data: bytes) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Coordinates, rounded half to even, and attributes gathered from columns name_0, name_1, ..."""
    v = parse_ply(data)["vertex"]
    coord = np.round(np.stack([v[a] for a in "xyz"], axis=1)).astype(np.int32)
    groups: dict[str, list[str]] = {}
    for key in v:
        if key not in "xyz":
            groups.setdefault(key.rpartition("_")[0], []).append(key)
    return coord, {name: np.stack([v[k] for k in sorted(keys, key=lambda k: int(k.rpartition("_")[2]))], axis=1) for name, keys in groups.items()}


def register(spark: SparkSession) -> None:
    """Make the formats vxz, npz and plyvoxel known to the session, and let filters reach them."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (VxzSource, NpzSource, PlySource):
        spark.dataSource.register(source)


def read_voxels(spark: SparkSession, path: str, attributes: Sequence[str] = ()) -> DataFrame:
    """By suffix: .npz, .ply or .vxz; another one is an error."""
    formats = {"npz": "npz", "ply": "plyvoxel", "vxz": "vxz"}
    suffix = path.rstrip("/").rpartition(".")[2]
    if suffix not in formats:
        raise ValueError(f"unknown voxel file: {path}")
    register(spark)
    return spark.read.format(formats[suffix]).option("attributes", ",".join(attributes)).load(path)


def read_meshes(spark: SparkSession, path: str) -> DataFrame:
    """(path, vertices array<array<double>>, tris, quads): PLY meshes; faces of other sizes are left out."""
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, out = batch.column("path").to_pylist(), ([], [], [])
            for data in batch.column("content").to_pylist():
                ply = parse_ply(data)
                v = ply["vertex"]
                out[0].append(np.stack([v[a] for a in "xyz"], axis=1).astype(float).tolist())
                faces = ply.get("face", {})
                lists = next(iter(faces.values()), [])
                for k, n in ((1, 3), (2, 4)):
                    out[k].append([f.astype(int).tolist() for f in lists if len(f) == n])
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(out[0], pa.list_(pa.list_(pa.float64()))), *[pa.array(o, pa.list_(pa.list_(pa.int32()))) for o in out[1:]]], names=["path", "vertices", "tris", "quads"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ply").load(path).select("path", "content")
    return files.mapInArrow(run, "path string, vertices array<array<double>>, tris array<array<int>>, quads array<array<int>>")


def read_mesh_sequences(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(path, frame, vid, x, y, z) and (path, fid, v0, v1, v2) of NPZ files with vertices (t, n, 3) and faces."""
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(path).select("path", "content")

    def vertices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                with np.load(io.BytesIO(data)) as z:
                    v = z["vertices"].astype(np.float32)
                for frame, one in enumerate(v):
                    n = len(one)
                    yield pa.RecordBatch.from_arrays([pa.array([p] * n), pa.array(np.full(n, frame, np.int32)), pa.array(np.arange(n, dtype=np.int32)), *[pa.array(one[:, i]) for i in range(3)]], names=["path", "frame", "vid", *"xyz"])

    def faces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                with np.load(io.BytesIO(data)) as z:
                    f = z["faces"].astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([p] * len(f)), pa.array(np.arange(len(f), dtype=np.int32)), *[pa.array(f[:, i]) for i in range(3)]], names=["path", "fid", "v0", "v1", "v2"])

    return files.mapInArrow(vertices, "path string, frame int, vid int, x float, y float, z float"), files.mapInArrow(faces, "path string, fid int, v0 int, v1 int, v2 int")


# --- writing --------------------------------------------------------------------------------------------------------


def _write_bytes(path: str, data: bytes) -> None:
    system, local = _open(path)
    system.create_dir(local.rpartition("/")[0], recursive=True)
    with system.open_output_stream(local) as f:
        f.write(data)


def _attributes(rows: pa.Table, layout: Sequence[tuple[str, int]]) -> np.ndarray:
    parts = [np.array(rows.column(n).to_pylist(), np.int64).reshape(rows.num_rows, c) for n, c in layout]
    out = np.concatenate(parts, axis=1) if parts else np.zeros((rows.num_rows, 0), np.int64)
    if ((out < 0) | (out > 255)).any():
        raise ValueError("attributes must be bytes")
    return out.astype(np.uint8)


def write_vxz(df: DataFrame, folder: str, layout: Sequence[tuple[str, int]], asset: str = "asset", chunk_size: int = 256, filter: str = "none", compression: str = "lzma", level: int | None = None, interleave: str = "as_is") -> DataFrame:
    """One file folder/{asset}.vxz per asset of df (asset, x, y, z, attributes); returns (asset, path, num_voxel).

    Chunks are encoded in parallel, a task per chunk; a second grouping only concatenates an asset's encoded chunks. Files are
    written whole under their own name, so that a task run again gives the same file.
    """
    if chunk_size < 2 or chunk_size & (chunk_size - 1):
        raise ValueError("the chunk size must be a power of two")
    ship(df.sparkSession)
    level = level or codecs.LEVELS[compression]
    rows = codecs.chunked(df, chunk_size).withColumn("asset", F.col(asset).cast("string"))

    def encode(rows: pa.Table) -> pa.Table:
        place = np.stack([rows.column(f"l{a}").to_numpy() for a in "xyz"], axis=1)
        idx = [rows.column(f"c{a}")[0].as_py() for a in "xyz"]
        info, data = encode_chunk(place, _attributes(rows, layout), chunk_size, layout, filter, compression, level, interleave)
        return pa.table({"asset": [rows.column("asset")[0].as_py()], "idx": pa.array([idx], pa.list_(pa.int32())), "n": pa.array([rows.num_rows], pa.int64()), "info": [json.dumps(info)], "data": pa.array([data], pa.binary())})

    def pack(rows: pa.Table) -> pa.Table:
        name = rows.column("asset")[0].as_py()
        chunks = sorted(zip(rows.column("idx").to_pylist(), rows.column("info").to_pylist(), rows.column("data").to_pylist(), strict=True), key=lambda c: c[0])
        n = sum(rows.column("n").to_pylist())
        header = {
            "num_voxel": n, "chunk_size": chunk_size, "filter": filter, "compression": compression, "compression_level": level,
            "raw_size": n * (12 + sum(c for _, c in layout)), "attr_interleave": interleave, "attr": [list(x) for x in layout],
        }
        path = f"{folder}/{name}.vxz"
        _write_bytes(path, pack_file([(i, json.loads(s), d) for i, s, d in chunks], header))
        return pa.table({"asset": [name], "path": [path], "num_voxel": pa.array([n], pa.int64())})

    encoded = rows.groupBy("asset", "cx", "cy", "cz").applyInArrow(encode, "asset string, idx array<int>, n long, info string, data binary")
    return encoded.groupBy("asset").applyInArrow(pack, "asset string, path string, num_voxel long")


def _write_assets(df: DataFrame, folder: str, asset: str, suffix: str, layout: Sequence[tuple[str, int]], make) -> DataFrame:
    ship(df.sparkSession)
    rows = df.withColumn("asset", F.col(asset).cast("string")).select("asset", "x", "y", "z", *[n for n, _ in layout])

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(a, "ascending") for a in "xyz"])
        name = rows.column("asset")[0].as_py()
        path = f"{folder}/{name}{suffix}"
        coord = np.stack([rows.column(a).to_numpy() for a in "xyz"], axis=1)
        _write_bytes(path, make(coord, _attributes(rows, layout)))
        return pa.table({"asset": [name], "path": [path], "num_voxel": pa.array([rows.num_rows], pa.int64())})

    return rows.groupBy("asset").applyInArrow(run, "asset string, path string, num_voxel long")


def _split(attr: np.ndarray, layout: Sequence[tuple[str, int]]) -> dict[str, np.ndarray]:
    ends = np.cumsum([c for _, c in layout])
    return {n: attr[:, e - c : e] for (n, c), e in zip(layout, ends, strict=True)}


def write_npz(df: DataFrame, folder: str, layout: Sequence[tuple[str, int]], asset: str = "asset", compressed: bool = True) -> DataFrame:
    def make(coord: np.ndarray, attr: np.ndarray) -> bytes:
        out = io.BytesIO()
        (np.savez_compressed if compressed else np.savez)(out, coord=coord.astype(np.uint16), **_split(attr, layout))
        return out.getvalue()

    return _write_assets(df, folder, asset, ".npz", layout, make)


def write_ply_voxels(df: DataFrame, folder: str, layout: Sequence[tuple[str, int]], asset: str = "asset") -> DataFrame:
    def make(coord: np.ndarray, attr: np.ndarray) -> bytes:
        names = [f"{n}_{i}" for n, c in layout for i in range(c)]
        rows = np.empty(len(coord), np.dtype([*[(a, "<f4") for a in "xyz"], *[(n, "u1") for n in names]]))
        for i, a in enumerate("xyz"):
            rows[a] = coord[:, i]
        for i, n in enumerate(names):
            rows[n] = attr[:, i]
        properties = [*[f"property float {a}" for a in "xyz"], *[f"property uchar {n}" for n in names]]
        return "\n".join(["ply", "format binary_little_endian 1.0", f"element vertex {len(coord)}", *properties, "end_header\n"]).encode() + rows.tobytes()

    return _write_assets(df, folder, asset, ".ply", layout, make)


def write_voxels(df: DataFrame, folder: str, kind: str, layout: Sequence[tuple[str, int]], **options) -> DataFrame:
    """By kind: npz, ply or vxz; another one is an error."""
    writers = {"npz": write_npz, "ply": write_ply_voxels, "vxz": write_vxz}
    if kind not in writers:
        raise ValueError(f"unknown voxel file kind: {kind}")
    return writers[kind](df, folder, layout, **options)


def mesh_ply(vertices: np.ndarray, tris: np.ndarray, quads: np.ndarray | None = None, binary: bool = True, colours: np.ndarray | None = None) -> bytes:
    """A PLY mesh; colours: bytes per vertex (3 or 4 columns)."""
    quads = np.zeros((0, 4), int) if quads is None or not len(quads) else quads
    shades = [] if colours is None else ["red", "green", "blue", "alpha"][: colours.shape[1]]
    head = ["ply", f"format {'binary_little_endian' if binary else 'ascii'} 1.0", f"element vertex {len(vertices)}"]
    head += [f"property float {a}" for a in "xyz"] + [f"property uchar {c}" for c in shades]
    head += [f"element face {len(tris) + len(quads)}", "property list uchar int vertex_index", "end_header\n"]
    if binary:
        rows = np.empty(len(vertices), np.dtype([*[(a, "<f4") for a in "xyz"], *[(c, "u1") for c in shades]]))
        for i, a in enumerate("xyz"):
            rows[a] = vertices[:, i]
        for i, c in enumerate(shades):
            rows[c] = colours[:, i]
        body = rows.tobytes()
        for faces, k in ((tris, 3), (quads, 4)):
            f = np.empty(len(faces), np.dtype([("n", "u1"), ("v", "<i4", (k,))]))
            f["n"], f["v"] = k, np.asarray(faces).reshape(-1, k)
            body += f.tobytes()
        return "\n".join(head).encode() + body
    lines = [" ".join([*[repr(float(x)) for x in v], *([] if colours is None else map(str, colours[i].tolist()))]) for i, v in enumerate(np.asarray(vertices, np.float32))]
    lines += [" ".join(map(str, [len(f), *map(int, f)])) for faces in (tris, quads) for f in faces]
    return ("\n".join(head) + "\n".join(lines) + "\n").encode()


def write_mesh_ply(df: DataFrame, folder: str, asset: str = "asset", binary: bool = True) -> DataFrame:
    """One PLY mesh per row of df (asset, vertices, tris, quads); returns (asset, path)."""
    ship(df.sparkSession)
    rows = df.select(F.col(asset).cast("string").alias("asset"), "vertices", "tris", "quads")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, paths = batch.column("asset").to_pylist(), []
            for name, v, t, q in zip(names, *[batch.column(c).to_pylist() for c in ("vertices", "tris", "quads")], strict=True):
                paths.append(f"{folder}/{name}.ply")
                _write_bytes(paths[-1], mesh_ply(np.array(v, float).reshape(-1, 3), np.array(t or [], int).reshape(-1, 3), np.array(q or [], int).reshape(-1, 4), binary))
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(paths)], names=["asset", "path"])

    return rows.mapInArrow(run, "asset string, path string")
