"""Sparse coordinate tables: one row per (b, x, y, z) with feature columns or an array of features.

All grouping is by integer coordinates (floor division), so that partial aggregation runs before the shuffle. Neighbour
joins replicate cells by a fixed list of offsets and meet in one equi-join; the offset list is a literal, never a table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lattica.functions import curves
from lattica.operators.catalog import running_total
from lattica.session import ship

KEY = ("b", "x", "y", "z")
AXES = ("x", "y", "z")
Offset = tuple[int, int, int]


def parent_of(axis: str, factor: int) -> Column:
    return F.floor(F.col(axis) / factor).cast("int")


def slot_of(factor: int) -> Column:
    """Which child of its parent a cell is: x + y f + z f^2 of the remainders."""
    out = F.lit(0)
    for i, axis in enumerate(AXES):
        out = out + F.pmod(F.col(axis), F.lit(factor)) * factor**i
    return out.cast("int")


def _parents(factor: int) -> list[Column]:
    return [F.col("b"), *[parent_of(a, factor).alias(a) for a in AXES]]


def pool(df: DataFrame, factor: int, feats: Sequence[str], how: str = "mean") -> DataFrame:
    """Cells merged by floor(c / factor); features by mean, max, min or sum."""
    fold: dict[str, Callable[[str], Column]] = {"mean": F.avg, "max": F.max, "min": F.min, "sum": F.sum}
    if how not in fold:
        raise ValueError(f"unknown pooling: {how}")
    return df.groupBy(*_parents(factor)).agg(*[fold[how](c).alias(c) for c in feats])


def pool_array(df: DataFrame, factor: int, feats: str = "feats", how: str = "mean") -> DataFrame:
    """The same for an array column, element by element."""
    fold = {"mean": F.avg, "max": F.max}[how]
    flat = df.select(*_parents(factor), F.posexplode(feats).alias("pos", "v"))
    one = flat.groupBy(*KEY, "pos").agg(fold("v").alias("v"))
    rows = one.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("pos", "v"))).alias("p"))
    return rows.select(*KEY, F.transform("p", lambda s: s["v"]).alias(feats))


def subdivision(df: DataFrame, factor: int = 2) -> DataFrame:
    """(b, x, y, z, mask) of the parents: bit s is set if child s exists."""
    return df.groupBy(*_parents(factor)).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), slot_of(factor))).alias("mask"))


def _children(factor: int) -> Column:
    bits = F.sequence(F.lit(0), F.lit(factor**3 - 1))
    return F.filter(bits, lambda i: F.getbit("mask", i) == 1)


def _child_coords(factor: int, slot: str) -> list[Column]:
    place = lambda i: F.pmod(F.floor(F.col(slot) / factor**i), F.lit(factor))
    return [F.col("b"), *[(F.col(a) * factor + place(i)).cast("int").alias(a) for i, a in enumerate(AXES)]]


def expand(df: DataFrame, factor: int = 2, feats: Sequence[str] = ()) -> DataFrame:
    """Every parent emits the children that its mask names; they copy its features."""
    rows = df.withColumn("__s", F.explode(_children(factor)))
    return rows.select(*_child_coords(factor, "__s"), *feats)


def space_to_channel(df: DataFrame, factor: int = 2, feats: str = "feats", width: int = 1) -> DataFrame:
    """Parents with the children's features side by side in slot order (absent children 0), and their mask."""
    slots = df.select(*_parents(factor), slot_of(factor).alias("__s"), feats)
    rows = slots.groupBy(*KEY).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__s"))).alias("mask"), F.map_from_entries(F.collect_list(F.struct("__s", feats))).alias("m")
    )  # a parent has factor ** 3 children at most
    zero = F.array_repeat(F.lit(0), width).cast(df.schema[feats].dataType)
    parts = F.transform(F.sequence(F.lit(0), F.lit(factor**3 - 1)), lambda s: F.coalesce(F.try_element_at("m", s), zero))
    return rows.select(*KEY, "mask", F.flatten(parts).alias(feats))


def channel_to_space(df: DataFrame, factor: int = 2, feats: str = "feats", width: int = 1) -> DataFrame:
    """The inverse: child s of the mask takes features s width ... (s + 1) width - 1."""
    rows = df.withColumn("__s", F.explode(_children(factor)))
    return rows.select(*_child_coords(factor, "__s"), F.slice(feats, F.col("__s") * width + 1, F.lit(width)).alias(feats))


def fold_channels(feats: Column, groups: int, width: int) -> Column:
    """Mean over runs of `width` channels, giving `groups` of them."""
    return F.transform(F.sequence(F.lit(0), F.lit(groups - 1)), lambda g: F.aggregate(F.slice(feats, g * width + 1, F.lit(width)), F.lit(0.0), lambda a, v: a + v) / width)


def repeat_channels(feats: Column, times: int) -> Column:
    return F.flatten(F.transform(feats, lambda v: F.array_repeat(v, times)))


# --- neighbour joins ------------------------------------------------------------------------------------------------

#: The four cells around an edge along x, y and z, in winding order.
QUAD: tuple[tuple[Offset, ...], ...] = (
    ((0, 0, 0), (0, 0, 1), (0, 1, 1), (0, 1, 0)),
    ((0, 0, 0), (1, 0, 0), (1, 0, 1), (0, 0, 1)),
    ((0, 0, 0), (0, 1, 0), (1, 1, 0), (1, 0, 0)),
)


def kernel_offsets(size: int = 3, dilation: int = 1) -> list[Offset]:
    r = range(-(size // 2), size // 2 + 1)
    return [(dx * dilation, dy * dilation, dz * dilation) for dx, dy, dz in product(r, r, r)]


def neighbours(cells: DataFrame, table: DataFrame, offsets: Sequence[Offset], carry: Sequence[str] = (), take: Sequence[str] = ()) -> DataFrame:
    """(cell key, carry..., k, take...): for each cell and offset number k, the cell of `table` at cell + offset, if there."""
    array = F.array(*[F.struct(F.lit(k).alias("k"), *[F.lit(d).alias(f"d{a}") for a, d in zip(AXES, o, strict=True)]) for k, o in enumerate(offsets)])
    asked = cells.select(*KEY, *carry, F.explode(array).alias("o"))
    asked = asked.select(*KEY, *carry, F.col("o.k").alias("k"), *[(F.col(a) + F.col(f"o.d{a}")).alias(f"n{a}") for a in AXES])
    held = table.select(F.col("b").alias("nb"), *[F.col(a).alias(f"n{a}") for a in AXES], *[F.col(t).alias(f"n_{t}") for t in take])
    return asked.join(held, (F.col("b") == F.col("nb")) & (asked["nx"] == held["nx"]) & (asked["ny"] == held["ny"]) & (asked["nz"] == held["nz"])).select(
        *KEY, *carry, "k", *[f"n_{t}" for t in take]
    )


def lookup(queries: DataFrame, table: DataFrame, values: Sequence[str]) -> DataFrame:
    """Values at the queried coordinates; null where there is no cell."""
    return queries.join(table.select(*KEY, *values), list(KEY), "left")


def complete_quads(cells: DataFrame, index: str, axis: int) -> DataFrame:
    """(b, x, y, z, axis, quad): cells whose four cells around the edge along the axis all exist; quad has their indices."""
    found = neighbours(cells, cells, QUAD[axis], take=[index])
    got = found.groupBy(*KEY).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("k", f"n_{index}"))).alias("q"))
    return got.where("n = 4").select(*KEY, F.lit(axis).alias("axis"), F.transform("q", lambda s: s[f"n_{index}"]).alias("quad"))


def submanifold_conv(cells: DataFrame, feature: str, weights: Sequence[float], offsets: Sequence[Offset] | None = None) -> DataFrame:
    """out[p] = sum over k of weights[k] in[p + offset k], at existing p only; missing neighbours add nothing."""
    offsets = offsets or kernel_offsets()
    found = neighbours(cells, cells, offsets, take=[feature])
    w = F.get(F.array(*[F.lit(x) for x in weights]), F.col("k"))
    return found.groupBy(*KEY).agg(F.sum(w * F.col(f"n_{feature}")).alias(feature))


def strided_conv(cells: DataFrame, feature: str, weights: Sequence[float], stride: int) -> DataFrame:
    """A convolution of size and stride `stride`: each parent sums its children by slot weight."""
    w = F.get(F.array(*[F.lit(x) for x in weights]), slot_of(stride))
    return cells.groupBy(*_parents(stride)).agg(F.sum(w * F.col(feature)).alias(feature))


def inverse_conv(coarse: DataFrame, fine: DataFrame, feature: str, weights: Sequence[float], stride: int) -> DataFrame:
    """Back to the saved fine coordinates: each takes its parent's value times its slot weight."""
    w = F.get(F.array(*[F.lit(x) for x in weights]), F.col("__s"))
    asked = fine.select(*KEY, slot_of(stride).alias("__s"), *[parent_of(a, stride).alias(f"p{a}") for a in AXES])
    up = coarse.select(F.col("b").alias("pb"), *[F.col(a).alias(f"q{a}") for a in AXES], F.col(feature).alias("__f"))
    on = (F.col("b") == F.col("pb")) & (F.col("px") == F.col("qx")) & (F.col("py") == F.col("qy")) & (F.col("pz") == F.col("qz"))
    return asked.join(up, on).select(*KEY, (w * F.col("__f")).alias(feature))


def trilinear(points: DataFrame, table: DataFrame, value: str, point_id: str, normalise: bool = False) -> DataFrame:
    """(point id, value): the values of the 8 cells around each point (px, py, pz in cell units, centres at + 0.5), by
    trilinear weights. A missing corner counts as 0; with normalise, the weights of those present add up to 1."""
    base = {a: F.floor(F.col(f"p{a}") - 0.5).cast("int") for a in AXES}
    frac = {a: F.col(f"p{a}") - 0.5 - base[a] for a in AXES}
    corner = lambda i, a, j: (i >> j) & 1
    corners = F.array(*[
        F.struct(
            *[(base[a] + corner(i, a, j)).alias(a) for j, a in enumerate(AXES)],
            (
                F.lit(1.0)
                * (frac["x"] if corner(i, "x", 0) else 1 - frac["x"])
                * (frac["y"] if corner(i, "y", 1) else 1 - frac["y"])
                * (frac["z"] if corner(i, "z", 2) else 1 - frac["z"])
            ).alias("w"),
        )
        for i in range(8)
    ])
    asked = points.select(point_id, "b", F.explode(corners).alias("c")).select(point_id, "b", "c.*")
    got = asked.join(table.select(*KEY, value), list(KEY), "left")
    total = F.sum(F.col("w") * F.coalesce(value, F.lit(0)))
    if normalise:
        total = total / F.sum(F.when(F.col(value).isNotNull(), F.col("w")))
    return got.groupBy(point_id).agg(total.alias(value))


# --- segments -------------------------------------------------------------------------------------------------------


def segment_reduce(df: DataFrame, segment: str, value: str | Column, how: str) -> DataFrame:
    fold = {"mean": F.avg, "sum": F.sum, "prod": F.product, "max": F.max, "min": F.min, "std": F.stddev_pop}[how]
    return df.groupBy(segment).agg(fold(value).alias("value"))


def segment_array_reduce(df: DataFrame, segment: str, feats: str, how: str) -> DataFrame:
    """Channels of a row first, then the rows of a segment."""
    add = lambda a, v: a + v
    row = {"mean": lambda c: F.aggregate(c, F.lit(0.0), add) / F.size(c), "sum": lambda c: F.aggregate(c, F.lit(0.0), add), "prod": lambda c: F.aggregate(c, F.lit(1.0), lambda a, v: a * v)}
    return segment_reduce(df, segment, row[how](F.col(feats)), how)


def segment_std(df: DataFrame, segment: str, feats: str) -> DataFrame:
    """sqrt(E[x^2] - E[x]^2), means over channels and then over rows."""
    mean = lambda c: F.aggregate(c, F.lit(0.0), lambda a, v: a + v) / F.size(c)
    got = df.groupBy(segment).agg(F.avg(mean(F.col(feats))).alias("m"), F.avg(mean(F.transform(feats, lambda v: v * v))).alias("q"))
    return got.select(segment, F.sqrt(F.greatest(F.col("q") - F.col("m") * F.col("m"), F.lit(0.0))).alias("value"))


def segment_offsets(df: DataFrame, segment: str) -> DataFrame:
    """(segment, n, start, stop): lengths and running offsets, summed in two phases."""
    counts = running_total(df.groupBy(segment).agg(F.count("*").alias("n")), "n", segment)
    return counts.select(segment, "n", (F.col("stop") - F.col("n")).alias("start"), "stop")


def to_dense(df: DataFrame, segment: str, order: str, values: Sequence[str], most: int | None = None) -> DataFrame:
    """(segment, pos, values..., valid): segments padded to the longest one; a padded place repeats the segment's last row. most:
    a longest one beyond it is an error, for it multiplies the table."""
    placed = df.withColumn("pos", (F.row_number().over(W.partitionBy(segment).orderBy(order)) - 1).cast("long"))
    counts = placed.groupBy(segment).agg(F.count("*").alias("n"))
    longest = counts.agg(F.max("n").alias("length"))
    if most is not None:
        too_long = F.raise_error(F.concat(F.lit("a segment has rows: "), F.col("length").cast("string")))
        longest = longest.select(F.when(F.col("length") <= most, F.col("length")).otherwise(too_long.cast("long")).alias("length"))
    spine = counts.crossJoin(F.broadcast(longest)).select(segment, "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1)).alias("at"))  # longest: one row
    spine = spine.withColumn("pos", F.least(F.col("at"), F.col("n") - 1))
    return spine.join(placed, [segment, "pos"]).select(segment, F.col("at").alias("pos"), *values, (F.col("at") < F.col("n")).alias("valid"))


def segment_norm(df: DataFrame, by: Sequence[str], value: str, eps: float = 0.0) -> DataFrame:
    """df with (value - mean) / sqrt(variance + eps) of its group."""
    w = W.partitionBy(*by)
    return df.withColumn("normed", (F.col(value) - F.avg(value).over(w)) / F.sqrt(F.var_pop(value).over(w) + eps))


def extents(df: DataFrame) -> DataFrame:
    return df.agg(*[(F.max(a) + 1).alias(f"size_{a}") for a in AXES])


def renumber_concat(tables: Sequence[DataFrame], batch: str = "b") -> DataFrame:
    """Union of batches; the batches of each table are shifted behind those before it. The shifts are one-row tables."""
    out, shift = None, None
    for df in tables:
        moved = df if shift is None else df.crossJoin(F.broadcast(shift)).withColumn(batch, (F.col(batch) + F.col("__shift")).cast(df.schema[batch].dataType)).drop("__shift")
        out = moved if out is None else out.unionByName(moved)
        own = df.agg(F.coalesce(F.max(batch) + 1, F.lit(0)).alias("__own"))
        shift = own.select(F.col("__own").alias("__shift")) if shift is None else shift.crossJoin(own).select((F.col("__shift") + F.col("__own")).alias("__shift"))
    return out


def select_batches(df: DataFrame, wanted: Sequence[int], batch: str = "b") -> DataFrame:
    """Batches gathered in the given order and renumbered; a batch named twice comes twice."""
    pairs = F.array(*[F.struct(F.lit(new).alias("new"), F.lit(old).alias("old")) for new, old in enumerate(wanted)])
    rows = df.withColumn("__p", F.explode(F.filter(pairs, lambda p: p["old"] == F.col(batch))))
    return rows.withColumn(batch, F.col("__p.new")).drop("__p")


def combine(a: DataFrame, b: DataFrame, op: Callable[[Column, Column], Column], feature: str) -> DataFrame:
    """Cell-wise op of two tables with the same cells."""
    return a.join(b.select(*KEY, F.col(feature).alias("__o")), list(KEY)).withColumn(feature, op(F.col(feature), F.col("__o"))).drop("__o")


def concat_channels(a: DataFrame, b: DataFrame, feats: str = "feats") -> DataFrame:
    return combine(a, b, F.concat, feats)


#: The six cells that share a face with a cell.
SIX: tuple[Offset, ...] = tuple(tuple(d if i == axis else 0 for i in range(3)) for axis in range(3) for d in (-1, 1))


def six_neighbours(cells: DataFrame, take: Sequence[str] = ()) -> DataFrame:
    """(cell key, k, take...) of the cells across a face that exist; k numbers -x, +x, -y, +y, -z, +z."""
    return neighbours(cells, cells, SIX, take=take)


def align_sorted(a: DataFrame, b: DataFrame, values_a: Sequence[str], values_b: Sequence[str]) -> DataFrame:
    """(b, x, y, z, values of both) of all cells of either set, merged in the order of their places on the z-order curve: both sides
    are ranged by (batch, code), so neighbours in space are neighbours in the result's partitions."""
    code = curves.z_order(*AXES).alias("__code")
    left, right = a.select("b", code, *values_a), b.select("b", code, *values_b)
    met = left.hint("merge").join(right, ["b", "__code"], "full")
    rows = met.repartitionByRange("b", "__code").sortWithinPartitions("b", "__code").withColumn("__c", curves.z_order_decode("__code"))
    return rows.select("b", *[F.col(f"__c.{k}").alias(k) for k in AXES], *values_a, *values_b)


def reshape(feats: Column, width: int) -> Column:
    """A flat channel array as rows of `width`; channels that don't fill the last row are an error."""
    rows = F.transform(F.sequence(F.lit(1), F.size(feats), F.lit(width)), lambda i: F.slice(feats, i, F.lit(width)))
    return F.when(F.pmod(F.size(feats), F.lit(width)) == 0, rows).otherwise(F.raise_error(F.lit(f"channels don't fill rows of {width}")))


def cast_channels(feats: Column, kind: str) -> Column:
    return feats.cast(f"array<{kind}>")


def batch_operand(df: DataFrame, operand: DataFrame, op: Callable[[Column, Column], Column], feats: str = "feats", value: str = "operand") -> DataFrame:
    """op of every row's channels with its batch's operand (b, operand array, a row per batch); a batch without one is an error."""
    met = df.join(operand.select("b", F.col(value).alias("__o")), "b", "left")
    there = F.when(F.col("__o").isNotNull(), F.zip_with(feats, "__o", op)).otherwise(F.array(F.raise_error(F.lit("a batch has no operand")).cast("double")))
    return met.withColumn(feats, there).drop("__o")


def _filling(feats: str, factor: int) -> Column:
    """The features, or an error if their number isn't a multiple of factor ** 3."""
    bad = F.raise_error(F.concat(F.lit(f"channels don't fill blocks of {factor}: "), F.size(feats).cast("string")))
    return F.when(F.size(feats) % factor**3 == 0, F.size(feats) / factor**3).otherwise(bad.cast("double")).cast("int")


def unpatchify(df: DataFrame, factor: int, feats: str = "feats") -> DataFrame:
    """Every cell as factor ** 3 finer ones: channel c f^3 + s goes to channel c of place s = (i f + j) f + k inside the cell. This is
    the dense pixel shuffle, too."""
    n = factor**3
    parts = F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda s: F.transform(F.slice(F.sequence(F.lit(0), F.col("__n")), F.lit(1), F.col("__n")), lambda c: F.get(feats, c * n + s)),
    )
    rows = df.withColumn("__n", _filling(feats, factor)).select(*KEY, F.posexplode(parts).alias("__s", "__f"))
    place = [(F.col(a) * factor + F.pmod(F.floor(F.col("__s") / factor ** (2 - i)), F.lit(factor))).cast("int").alias(a) for i, a in enumerate(AXES)]
    return rows.select("b", *place, F.col("__f").alias(feats))


pixel_shuffle = unpatchify


def patchify(df: DataFrame, factor: int, feats: str = "feats") -> DataFrame:
    """The inverse: the factor ** 3 cells of a block, all of which must exist, as one cell with all their channels."""
    slot = F.lit(0)
    for a in AXES:
        slot = slot * factor + F.pmod(F.col(a), F.lit(factor))
    rows = df.select(*_parents(factor), slot.cast("int").alias("__s"), F.col(feats).alias("__f"))
    held = rows.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("__s", "__f"))).alias("__t"))  # a block has factor ** 3 cells
    whole = F.transform(F.col("__t"), lambda t: t["__s"]) == F.sequence(F.lit(0), F.lit(factor**3 - 1))
    across = lambda c: F.transform(F.col("__t"), lambda t: F.get(t["__f"], c))
    last = F.size(F.get("__t", F.lit(0))["__f"]) - 1
    kind = df.schema[feats].dataType
    gap = F.raise_error(F.lit(f"a block of {factor} lacks cells")).cast("string")
    return held.select(*KEY, F.when(whole, F.flatten(F.transform(F.sequence(F.lit(0), last), across))).otherwise(F.from_json(gap, kind.simpleString())).alias(feats))


def same_cells(a: DataFrame, b: DataFrame) -> bool:
    """Do both tables have exactly the same coordinates?"""
    x, y = a.select(*KEY), b.select(*KEY)
    return x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty()


def full_grid(spark, batches: int, size: tuple[int, int, int], value) -> DataFrame:
    """Every cell of the box, from one distributed range."""
    w, h, d = size
    i = F.col("id")
    return spark.range(batches * w * h * d).select(
        F.floor(i / (w * h * d)).cast("int").alias("b"), F.floor(F.pmod(i, F.lit(w * h * d)) / (h * d)).cast("int").alias("x"),
        F.floor(F.pmod(i, F.lit(h * d)) / d).cast("int").alias("y"), F.pmod(i, F.lit(d)).cast("int").alias("z"), F.lit(value).alias("value"),
    )


def densify(df: DataFrame, batches: int, size: tuple[int, int, int], value: str) -> DataFrame:
    grid = full_grid(df.sparkSession, batches, size, 0).drop("value")
    return grid.join(df.select(*KEY, value), list(KEY), "left").withColumn(value, F.coalesce(value, F.lit(0)))


def occupancy(df: DataFrame, factor: int) -> DataFrame:
    """Cells of the coarser grid that hold any cell."""
    return df.select(*_parents(factor)).distinct()


def sparsify(df: DataFrame, value: str) -> DataFrame:
    return df.where(F.col(value) > 0)


def requantise(coord: Column, source: int, target: int) -> Column:
    """The cell of a grid of `target` that holds the centre of a cell of a grid of `source`."""
    return ((coord + 0.5) / source * target).cast("int")


def token_budget(df: DataFrame, source: int, candidates: Sequence[int], most: int, floor: int) -> DataFrame:
    """(res, n): the largest candidate resolution with fewer than `most` distinct cells, else `floor`; all in one pass."""
    rows = df.select(*KEY, F.explode(F.array(*[F.lit(r) for r in candidates])).alias("res"))
    scaled = [((F.col(a) + 0.5) / source * F.col("res")).cast("int").alias(a) for a in AXES]
    counts = rows.select("res", "b", *scaled).distinct().groupBy("res").agg(F.count("*").alias("n"))
    fits = F.max(F.when(F.col("n") < most, F.col("res")))
    return counts.agg(F.coalesce(fits, F.lit(floor)).alias("res"), F.max_by("n", F.when(F.col("n") < most, F.col("res"))).alias("n"))


# --- windows --------------------------------------------------------------------------------------------------------


def window_id(size: int, shift: int, extent: tuple[int, int, int]) -> Column:
    """Number of the shifted window of a cell, batch first; extent: the largest coordinate plus one of each axis."""
    counts = [-(-(e + shift + 1) // size) for e in extent]
    out = F.col("b").cast("long")
    for a, n in zip(AXES, counts, strict=True):
        out = out * n + F.floor((F.col(a) + shift) / size).cast("long")
    return out


def window_partition(df: DataFrame, size: int, shift: int, extent: tuple[int, int, int]) -> DataFrame:
    return df.withColumn("window", window_id(size, shift, extent))


def window_lengths(df: DataFrame, size: int, shift: int, extent: tuple[int, int, int]) -> DataFrame:
    return window_partition(df, size, shift, extent).groupBy("window").agg(F.count("*").alias("n"))


def attention(df: DataFrame, group: str, q: str, k: str, v: str, keep: Sequence[str]) -> DataFrame:
    """softmax(q k^T / sqrt(d)) v inside each group; q, k, v are arrays of float. A group is one window or one batch
    element, whose size the model bounds."""
    ship(df.sparkSession)
    kept = [f for f in df.schema.fields if f.name in (group, *keep)]

    def run(rows: pa.Table) -> pa.Table:
        a, b, c = (np.array(rows.column(n).to_pylist(), np.float64) for n in (q, k, v))
        s = a @ b.T / np.sqrt(a.shape[1])
        s = np.exp(s - s.max(axis=1, keepdims=True))
        out = (s / s.sum(axis=1, keepdims=True)) @ c
        return pa.table({**{f.name: rows.column(f.name) for f in kept}, "out": pa.array(out.tolist(), pa.list_(pa.float64()))})

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", out array<double>"
    return df.groupBy(group).applyInArrow(run, schema)


def cross_attention(queries: DataFrame, keys: DataFrame, group: str, q: str, k: str, v: str, keep: Sequence[str]) -> DataFrame:
    """The same with queries and keys of two tables, cogrouped; a group without keys gives nothing."""
    ship(queries.sparkSession)
    kept = [f for f in queries.schema.fields if f.name in (group, *keep)]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        n = left.num_rows if right.num_rows else 0
        left = left.slice(0, n)
        out: list = []
        if n:
            a, b, c = np.array(left.column(q).to_pylist(), np.float64), np.array(right.column(k).to_pylist(), np.float64), np.array(right.column(v).to_pylist(), np.float64)
            s = a @ b.T / np.sqrt(a.shape[1])
            s = np.exp(s - s.max(axis=1, keepdims=True))
            out = ((s / s.sum(axis=1, keepdims=True)) @ c).tolist()
        return pa.table({**{f.name: left.column(f.name) for f in kept}, "out": pa.array(out, pa.list_(pa.float64()))})

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", out array<double>"
    keys = keys.select(*[F.col(c).alias(c) for c in keys.columns])  # columns of their own, also if both come from one table
    return queries.groupBy(group).cogroup(keys.groupBy(group)).applyInArrow(run, schema)


# --- channels -------------------------------------------------------------------------------------------------------


def zip_op(a: Column, b: Column, op: Callable[[Column, Column], Column]) -> Column:
    return F.zip_with(a, b, op)


def normalise(feats: Column, mean: Sequence[float], std: Sequence[float]) -> Column:
    return F.zip_with(F.zip_with(feats, F.array(*map(F.lit, mean)), lambda v, m: v - m), F.array(*map(F.lit, std)), lambda v, s: v / s)


def denormalise(feats: Column, mean: Sequence[float], std: Sequence[float]) -> Column:
    return F.zip_with(F.zip_with(feats, F.array(*map(F.lit, std)), lambda v, s: v * s), F.array(*map(F.lit, mean)), lambda v, m: v + m)


def channels(feats: Column, layout: dict[str, tuple[int, int]], name: str) -> Column:
    """The named channels of a feature array; layout: name -> (first, past the last)."""
    first, stop = layout[name]
    return F.slice(feats, first + 1, stop - first)


def group_norm(df: DataFrame, batch: str, feats: str, groups: int, width: int, eps: float = 1e-5) -> DataFrame:
    """Per batch and group of `width` channels: (x - mean) / sqrt(variance + eps), over all its rows and channels."""
    flat = df.withColumn("__row", F.monotonically_increasing_id()) if "__row" not in df.columns else df
    long = flat.select("*", F.posexplode(feats).alias("__c", "__v")).withColumn("__g", F.floor(F.col("__c") / width))
    stats = long.groupBy(batch, "__g").agg(F.avg("__v").alias("__m"), F.var_pop("__v").alias("__s"))
    per = stats.groupBy(batch).agg(F.array_sort(F.collect_list(F.struct("__g", "__m", "__s"))).alias("__t"))  # one per channel group
    take = lambda i, f: F.get(F.col("__t"), F.floor(i / width).cast("int"))[f]
    return df.join(per, batch).withColumn(feats, F.transform(feats, lambda v, i: (v - take(i, "__m")) / F.sqrt(take(i, "__s") + eps))).drop("__t")
