"""Catalog operators: layered overlays by key, work lists, funnels, shards, statistics.

Null semantics: a flag that is missing counts as not done (`not_done`), and as false where a stage requires it
(`flag_true`); a score that is null or NaN never passes a threshold.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lattica.session import checkpoint


def assert_keyed(df: DataFrame, key: str) -> DataFrame:
    """df, or an error if a key occurs twice or is null."""
    bad = df.groupBy(key).count().where(F.col("count") > 1).union(df.where(F.col(key).isNull()).groupBy(key).count()).limit(1).collect()
    if bad:
        raise ValueError(f"{key} isn't a key: {bad[0][key]!r} occurs {bad[0]['count']} times")
    return df


def overlay(layers: Sequence[DataFrame], key: str = "sha256") -> DataFrame:
    """Cell-wise first non-null over layers, the first layer first; rows and columns are united.

    All layers meet in one union and one partial aggregation, however many there are, and a filter on the key reaches
    every layer's scan. Layers must be keyed (see assert_keyed; overlay_join keeps duplicates instead).
    """
    prio = "__prio"
    united = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn(prio, F.lit(i)) for i, df in enumerate(layers)]
    )
    cells = [c for c in united.columns if c not in (key, prio)]
    picked = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(prio))).alias(c) for c in cells]
    return united.groupBy(key).agg(*picked) if picked else united.select(key).distinct()


def overlay_join(a: DataFrame, b: DataFrame, key: str = "sha256") -> DataFrame:
    """The same for two layers as a full outer join, in which duplicate keys multiply."""
    shared = [c for c in a.columns if c in b.columns and c != key]
    right = b.withColumnsRenamed({c: f"__{c}" for c in shared})
    joined = a.join(right, key, "full")
    return joined.select(
        key,
        *[F.coalesce(c, f"__{c}").alias(c) if c in shared else F.col(c) for c in a.columns if c != key],
        *[c for c in b.columns if c != key and c not in shared],
    )


def merge_records(base: DataFrame, parts: dict[str, DataFrame], key: str = "sha256") -> DataFrame:
    """Base with record parts laid over it; a new part wins over base, and among parts the last file name wins."""
    return overlay([parts[name] for name in sorted(parts, reverse=True)] + [base], key)


def last_writer(df: DataFrame, key: str, order: str) -> DataFrame:
    """The whole row with the greatest `order` of each key."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("row")).select(key, "row.*")


# --- predicates -----------------------------------------------------------------------------------------------------


def at_least(score: str, threshold: float) -> Column:
    """score >= threshold; null and NaN fail."""
    c = F.col(score)
    return F.coalesce(~F.isnan(c) & (c >= threshold), F.lit(False))


def at_most(value: str, most: float) -> Column:
    return F.coalesce(F.col(value) <= most, F.lit(False))


def flag_true(flag: str) -> Column:
    return F.coalesce(F.col(flag), F.lit(False))


def any_flag(*flags: str) -> Column:
    return reduce(lambda a, b: a | b, map(flag_true, flags))


def not_done(df: DataFrame, flag: str) -> Column:
    """True unless the flag is true; an absent column means that nothing is done."""
    return ~F.col(flag).eqNullSafe(True) if flag in df.columns else F.lit(True)


def any_not_done(df: DataFrame, flags: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [not_done(df, f) for f in flags])


def missing(df: DataFrame, column: str) -> Column:
    """True where the column is null; everywhere if there is no such column."""
    return F.col(column).isNull() if column in df.columns else F.lit(True)


def full_texture(base: str, metallic: str, roughness: str) -> Column:
    return F.coalesce((F.col(base) > 0) & (F.col(metallic) > 0) & (F.col(roughness) > 0), F.lit(False))


# --- selection ------------------------------------------------------------------------------------------------------


def only(df: DataFrame, keys: DataFrame, *on: str) -> DataFrame:
    return df.join(keys.select(*on).distinct(), list(on), "left_semi")


def without(df: DataFrame, done: DataFrame, *on: str) -> DataFrame:
    return df.join(done.select(*on).distinct(), list(on), "left_anti")


def view_key(shard: str, obj: str, view: str) -> Column:
    return F.format_string("%s/%s/view_%02d", F.col(shard), F.col(obj), F.col(view).cast("int"))


def worklist(
    catalog: DataFrame, key: str, predicates: Sequence[Column] = (), instances: DataFrame | None = None, done: DataFrame | None = None
) -> DataFrame:
    """Rows to work on: explicit instances bypass all predicates; what has an output already is left out either way."""
    rows = only(catalog, instances, key) if instances is not None else reduce(lambda df, p: df.where(p), predicates, catalog)
    return without(rows, done, key) if done is not None else rows


def verified(catalog: DataFrame, fetched: DataFrame, key: str, on: str, found: str) -> tuple[DataFrame, DataFrame]:
    """Fetched rows whose hash equals the catalog's key, and those that don't."""
    rows = fetched.join(catalog.select(on, key), on)
    return rows.where(F.col(found) == F.col(key)), rows.where(~F.col(found).eqNullSafe(F.col(key)))


def funnel(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """(step, name, survivors): rows left after each predicate, all in one pass."""
    held, counts = F.lit(True), [F.count("*").alias("n0")]
    for i, (_, p) in enumerate(steps, 1):
        held = held & F.coalesce(p, F.lit(False))
        counts.append(F.coalesce(F.sum(held.cast("long")), F.lit(0)).alias(f"n{i}"))
    rows = [F.struct(F.lit(i).alias("step"), F.lit(n).alias("name"), F.col(f"n{i}").cast("long").alias("survivors")) for i, n in enumerate(["total", *[n for n, _ in steps]])]
    return df.agg(*counts).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# --- shards ---------------------------------------------------------------------------------------------------------


def global_index(df: DataFrame, *order: str | Column, name: str = "i") -> DataFrame:
    """df with the 0-based place of each row in the given order, without bringing all rows to one task: a range
    partitioning, the place inside the partition, and the partition's offset from the partitions' counts."""
    laid = df.repartitionByRange(*order).sortWithinPartitions(*order)
    laid = checkpoint(laid.select("*", F.spark_partition_id().alias("__p"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("__j")))
    counts = laid.groupBy("__p").count()
    starts = counts.select("__p", (F.sum("count").over(W.orderBy("__p").rowsBetween(W.unboundedPreceding, 0)) - F.col("count")).alias("__s"))
    return laid.join(starts, "__p").withColumn(name, F.col("__s") + F.col("__j")).drop("__p", "__j", "__s")


def running_total(df: DataFrame, value: str, *order: str, name: str = "stop") -> DataFrame:
    """df with the sum of `value` up to and with each row in the given order: in two phases, like global_index."""
    laid = checkpoint(df.repartitionByRange(*order).select("*", F.spark_partition_id().alias("__p")))
    sums = laid.groupBy("__p").agg(F.sum(value).alias("__t"))
    before = sums.select("__p", (F.sum("__t").over(W.orderBy("__p").rowsBetween(W.unboundedPreceding, 0)) - F.col("__t")).alias("__s"))
    inside = F.sum(value).over(W.partitionBy("__p").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    return laid.withColumn("__r", inside).join(before, "__p").withColumn(name, F.col("__s") + F.col("__r")).drop("__p", "__s", "__r")


def shard_of(i: Column, n: Column, world: int) -> Column:
    """The rank whose slice [n r // W, n (r + 1) // W) holds place i."""
    return F.floor(((i + 1) * world - 1) / n).cast("int")


def with_shard(df: DataFrame, world: int, *order: str, name: str = "rank") -> DataFrame:
    rows = global_index(df, *order, name="__i")
    n = rows.agg(F.count("*").alias("__n"))
    return rows.crossJoin(F.broadcast(n)).withColumn(name, shard_of(F.col("__i"), F.col("__n"), world)).drop("__i", "__n")  # n: one row


def shard_then_filter(df: DataFrame, world: int, rank: int, predicate: Column, *order: str) -> DataFrame:
    """Stable chunk per rank, then the filter."""
    return with_shard(df, world, *order, name="__r").where(F.col("__r") == rank).drop("__r").where(predicate)


def filter_then_shard(df: DataFrame, world: int, rank: int, predicate: Column, *order: str) -> DataFrame:
    """The filter, then a balanced chunk per rank."""
    return with_shard(df.where(predicate), world, *order, name="__r").where(F.col("__r") == rank).drop("__r")


def priority_first(df: DataFrame, priority: Column, *order: str, name: str = "i") -> DataFrame:
    """Places in which prioritised rows come first and each part keeps its order."""
    marked = df.withColumn("__prio", F.when(F.coalesce(priority, F.lit(False)), 0).otherwise(1))
    return global_index(marked, "__prio", *order, name=name).drop("__prio")


# --- statistics -----------------------------------------------------------------------------------------------------


def stage_stats(df: DataFrame, present: Sequence[str] = (), flags: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """Total, how many values of `present` aren't null, and how many `flags` are true, in one pass."""
    aggs = [F.count("*").alias("total")]
    aggs += [F.count(c).alias(f"n_{c}") for c in present]
    aggs += [F.coalesce(F.sum(flag_true(c).cast("long")), F.lit(0)).alias(f"n_{c}") for c in flags]
    return df.groupBy(*by).agg(*aggs)


def status_histogram(df: DataFrame, status: str = "status") -> DataFrame:
    return df.groupBy(F.coalesce(status, F.lit("unknown")).alias(status)).agg(F.count("*").alias("n"))


def asset_counts(df: DataFrame, objects: str = "objects", materials: str = "materials") -> DataFrame:
    """num_faces, num_vertices (objects without vertices or faces are left out) and textures by kind of nested dumps."""
    full = F.filter(objects, lambda o: (F.size(o["vertices"]) > 0) & (F.size(o["faces"]) > 0))
    total = lambda field: F.aggregate(full, F.lit(0).cast("long"), lambda acc, o: acc + F.size(o[field]))
    out = {"num_faces": total("faces"), "num_vertices": total("vertices")}
    for kind in ("baseColor", "metallic", "roughness", "alpha"):
        out[f"num_{kind.lower()}_tex"] = F.size(F.filter(F.transform(materials, lambda m: m[f"{kind}Texture"]), lambda t: t.isNotNull())).cast("long")  # noqa: B023
    return df.withColumns(out)


def classify_status(mesh_missing: Column, camera_missing: Column, faces: Column, expected: Column, most: int = 500_000) -> Column:
    return (
        F.when(mesh_missing, "missing_mesh").when(camera_missing, "missing_camera").when(faces != expected, "face_mismatch")
        .when(faces > most, "skipped_too_many_faces").otherwise("success")
    )


def split_entry(path: Column, suffix: str = "_static_camera_distance_v3") -> Column:
    """(shard, obj) of `.../{shard}{suffix}/{obj}`."""
    parts = F.split(path, "/")
    return F.struct(F.split_part(F.element_at(parts, -2), F.lit(suffix), F.lit(1)).alias("shard"), F.element_at(parts, -1).alias("obj"))


def latest_step(paths: DataFrame, column: str = "path") -> DataFrame:
    step = F.regexp_extract(column, r"step(\d+)", 1)
    return paths.agg(F.max(F.when(step != "", step.cast("long"))).alias("step"))


def cross_views(objects: DataFrame, views: Sequence[int]) -> DataFrame:
    """Every object with every view of a list given by the caller."""
    return objects.withColumn("view", F.explode(F.array(*[F.lit(v).cast("int") for v in views])))


def suffixed(df: DataFrame, columns: Sequence[str], suffix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}_{suffix}" for c in columns})


def unsuffixed(df: DataFrame, suffix: str) -> DataFrame:
    return df.withColumnsRenamed({c: c.removesuffix(f"_{suffix}") for c in df.columns if c.endswith(f"_{suffix}")})


#: Declared schemas of the catalog's stages; every column but the key may be null.
STAGES = {
    name: T.StructType([T.StructField("sha256", T.StringType()), *[T.StructField(c, t) for c, t in cols]])
    for name, cols in {
        "metadata": [("file_identifier", T.StringType()), ("aesthetic_score", T.DoubleType())],
        "aesthetic_scores": [("aesthetic_score", T.DoubleType())],
        "raw": [("local_path", T.StringType())],
        "thumbnails": [("thumbnailed", T.BooleanType())],
        "mesh_dumps": [("mesh_dumped", T.BooleanType())],
        "pbr_dumps": [("pbr_dumped", T.BooleanType())],
        "asset_stats": [(c, T.LongType()) for c in ("num_faces", "num_vertices", "num_basecolor_tex", "num_metallic_tex", "num_roughness_tex", "num_alpha_tex")],
        "dual_grid": [("dual_grid_converted", T.BooleanType()), ("dual_grid_size", T.LongType())],
        "pbr_voxels": [("pbr_voxelized", T.BooleanType()), ("num_pbr_voxels", T.LongType())],
        "shape_latents": [("shape_latent_encoded", T.BooleanType()), ("shape_latent_tokens", T.LongType())],
        "pbr_latents": [("pbr_latent_encoded", T.BooleanType()), ("pbr_latent_tokens", T.LongType())],
        "ss_latents": [("ss_latent_encoded", T.BooleanType())],
        "renders_cond": [("cond_rendered", T.BooleanType())],
    }.items()
}
