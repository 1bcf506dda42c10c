"""Coordinate, curve and codec queries: line items stand in for voxels at (quantity, discount, tax)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.functions import curves, scalars
from lattica.operators import codecs, geometry
from lattica.operators import coords as K
from lattica.plans.registry import query, table

VOXELS = """
v as (select (l_linenumber % 2)::int as b, trunc(l_quantity)::int as x, round(l_discount * 100)::int as y, round(l_tax * 100)::int as z,
    count(*)::bigint as n, sum(round(l_extendedprice * 100)::bigint)::bigint as p from lineitem group by 1, 2, 3, 4)
"""
KEY = ["b", "x", "y", "z"]


def voxels(spark: SparkSession, sf: str) -> DataFrame:
    cent = lambda c: F.round(F.col(c) * 100).cast("long")
    rows = table(spark, sf, "lineitem").select(
        (F.col("l_linenumber") % 2).cast("int").alias("b"), F.col("l_quantity").cast("int").alias("x"), cent("l_discount").cast("int").alias("y"),
        cent("l_tax").cast("int").alias("z"), cent("l_extendedprice").alias("p"),
    )
    return rows.groupBy(*KEY).agg(F.count("*").alias("n"), F.sum("p").alias("p"))


@query(f"with {VOXELS} select b, x // 2 as x, y // 2 as y, z // 2 as z, round(avg(p), 4) as p, max(n) as n from v group by 1, 2, 3, 4")
def voxel_pool_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Mean pooling (and the largest count)."""
    v = voxels(spark, sf)
    mean, most = K.pool(v, 2, ["p"]), K.pool(v, 2, ["n"], "max")
    return mean.join(most, KEY).withColumn("p", F.round("p", 4))


@query(f"with {VOXELS} select b, x // 4 as x, y // 4 as y, z // 4 as z, max(p) as p, max(n) as n from v group by 1, 2, 3, 4")
def voxel_pool_max(spark: SparkSession, sf: str) -> DataFrame:
    return K.pool(voxels(spark, sf), 4, ["p", "n"], "max")


@query(f"with {VOXELS} select b, x // 2 as x, y // 2 as y, z // 2 as z, bit_or(1 << (x % 2 + y % 2 * 2 + z % 2 * 4))::bigint as mask from v group by 1, 2, 3, 4")
def subdivision_mask(spark: SparkSession, sf: str) -> DataFrame:
    return K.subdivision(voxels(spark, sf))


@query(f"with {VOXELS}, q as (select b, x // 2 as x, y // 2 as y, z // 2 as z, max(p) as m from v group by 1, 2, 3, 4) select v.b, v.x, v.y, v.z, q.m as p from v join q on v.b = q.b and v.x // 2 = q.x and v.y // 2 = q.y and v.z // 2 = q.z")
def expand_mask(spark: SparkSession, sf: str) -> DataFrame:
    """F8: children of the mask copy the pooled feature; pool and expand give the same cells."""
    v = voxels(spark, sf)
    return K.expand(K.pool(v, 2, ["p"], "max").join(K.subdivision(v), KEY), 2, ["p"])


_SLOTS = ", ".join(f"coalesce(max(p) filter (x % 2 + y % 2 * 2 + z % 2 * 4 = {i}), 0)::bigint as s{i}" for i in range(8))


@query(f"with {VOXELS} select b, x // 2 as x, y // 2 as y, z // 2 as z, {_SLOTS} from v group by 1, 2, 3, 4")
def space_to_channel(spark: SparkSession, sf: str) -> DataFrame:
    """The eight children side by side."""
    rows = K.space_to_channel(voxels(spark, sf).select(*KEY, F.array("p").alias("feats")))
    return rows.select(*KEY, *[F.get("feats", F.lit(i)).alias(f"s{i}") for i in range(8)])


@query(f"with {VOXELS} select b, x, y, z, p, n from v")
def channel_to_space(spark: SparkSession, sf: str) -> DataFrame:
    """unpivoting the pivot gives the cells back."""
    rows = K.space_to_channel(voxels(spark, sf).select(*KEY, F.array("p", "n").alias("feats")), width=2)
    return K.channel_to_space(rows, width=2).select(*KEY, F.get("feats", F.lit(0)).alias("p"), F.get("feats", F.lit(1)).alias("n"))


_QUADS = " union all ".join(
    f"select a.b, a.x, a.y, a.z, {axis} as axis from v a "
    + " ".join(f"join v n{i} on n{i}.b = a.b and n{i}.x = a.x + {o[0]} and n{i}.y = a.y + {o[1]} and n{i}.z = a.z + {o[2]}" for i, o in enumerate(offsets) if i)
    for axis, offsets in enumerate(K.QUAD)
)


@query(f"with {VOXELS} {_QUADS}")
def quad_complete(spark: SparkSession, sf: str) -> DataFrame:
    """Cells whose four cells around an edge exist, per axis."""
    v = voxels(spark, sf)
    out = [K.complete_quads(v, "p", axis).drop("quad") for axis in range(3)]
    return out[0].union(out[1]).union(out[2])


_OFFSETS = "o as (select dx, dy, dz, (dx + 1) * 9 + (dy + 1) * 3 + dz + 2 as w from unnest([-1, 0, 1]) a(dx), unnest([-1, 0, 1]) b(dy), unnest([-1, 0, 1]) c(dz))"


@query(f"with {VOXELS}, {_OFFSETS} select v.b, v.x, v.y, v.z, sum(w * u.n)::bigint as n from v, o, v u where u.b = v.b and u.x = v.x + dx and u.y = v.y + dy and u.z = v.z + dz group by 1, 2, 3, 4")
def conv3_sum(spark: SparkSession, sf: str) -> DataFrame:
    """A 3 x 3 x 3 submanifold convolution with integer weights."""
    return K.submanifold_conv(voxels(spark, sf), "n", list(range(1, 28)))


@query(f"with {VOXELS} select b, x // 2 as x, y // 2 as y, z // 2 as z, sum((x % 2 + y % 2 * 2 + z % 2 * 4 + 1) * n)::bigint as n from v group by 1, 2, 3, 4")
def conv_strided(spark: SparkSession, sf: str) -> DataFrame:
    return K.strided_conv(voxels(spark, sf), "n", list(range(1, 9)), 2)


@query(f"with {VOXELS}, c as (select b, x // 2 as x, y // 2 as y, z // 2 as z, sum(n) as n from v group by 1, 2, 3, 4) select v.b, v.x, v.y, v.z, ((v.x % 2 + v.y % 2 * 2 + v.z % 2 * 4 + 1) * c.n)::bigint as n from v join c on v.b = c.b and v.x // 2 = c.x and v.y // 2 = c.y and v.z // 2 = c.z")
def conv_inverse(spark: SparkSession, sf: str) -> DataFrame:
    v = voxels(spark, sf)
    return K.inverse_conv(K.pool(v, 2, ["n"], "sum"), v, "n", list(range(1, 9)), 2)


@query(f"with {VOXELS}, e as (select event_id, 0 as b, event_id % 40 as x, event_id % 12 as y, event_id % 9 as z from events) select e.event_id, e.b::int as b, e.x::int as x, e.y::int as y, e.z::int as z, v.p from e left join v on v.b = e.b and v.x = e.x and v.y = e.y and v.z = e.z")
def coordinate_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """A miss is null."""
    e = table(spark, sf, "events").select("event_id", F.lit(0).alias("b"), *[(F.col("event_id") % m).cast("int").alias(a) for a, m in (("x", 40), ("y", 12), ("z", 9))])
    return K.lookup(e, voxels(spark, sf), ["p"]).select("event_id", *KEY, "p")


@query(f"""
with {VOXELS}, e as (select event_id, event_id % 40 + 0.25 as px, event_id % 8 + 0.5 as py, event_id % 6 + 0.75 as pz from events),
c as (select event_id, floor(px - 0.5)::int + i as x, floor(py - 0.5)::int + j as y, floor(pz - 0.5)::int + k as z,
    (case when i = 1 then px - 0.5 - floor(px - 0.5) else 1 - (px - 0.5 - floor(px - 0.5)) end) * (case when j = 1 then py - 0.5 - floor(py - 0.5) else 1 - (py - 0.5 - floor(py - 0.5)) end)
    * (case when k = 1 then pz - 0.5 - floor(pz - 0.5) else 1 - (pz - 0.5 - floor(pz - 0.5)) end) as w
    from e, unnest([0, 1]) t(i), unnest([0, 1]) u(j), unnest([0, 1]) s(k))
select event_id, round(sum(w::double * coalesce(n, 0)), 6) as n from c left join v on v.b = 1 and v.x = c.x and v.y = c.y and v.z = c.z group by 1
""")
def trilinear_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """A missing corner counts as 0."""
    point = {a: (F.col("event_id") % m + d).cast("double") for a, m, d in (("px", 40, 0.25), ("py", 8, 0.5), ("pz", 6, 0.75))}
    e = table(spark, sf, "events").select("event_id", F.lit(1).alias("b"), *[c.alias(a) for a, c in point.items()])
    return K.trilinear(e, voxels(spark, sf), "n", "event_id").withColumn("n", F.round("n", 6))


@query("select conv_id, count(*)::bigint as n, sum(length(text))::bigint as total, round(avg(length(text)), 6) as mean, max(length(text))::int as longest, round(stddev_pop(length(text)), 6) as std from conversations group by 1")
def segment_reduce(spark: SparkSession, sf: str) -> DataFrame:
    """Reductions over ragged segments."""
    rows = table(spark, sf, "conversations").withColumn("len", F.length("text"))
    out = rows.groupBy("conv_id").agg(F.count("*").alias("n"))
    for name, how in (("total", "sum"), ("mean", "mean"), ("longest", "max"), ("std", "std")):
        one = K.segment_reduce(rows, "conv_id", "len", how).withColumnRenamed("value", name)
        out = out.join(one, "conv_id")
    return out.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query("select l_suppkey, n, (sum(n) over (order by l_suppkey) - n)::bigint as start, sum(n) over (order by l_suppkey)::bigint as stop from (select l_suppkey, count(*)::bigint as n from lineitem group by 1)")
def running_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Segment lengths and offsets."""
    return K.segment_offsets(table(spark, sf, "lineitem").select("l_suppkey"), "l_suppkey")


@query("""
with c as (select conv_id, turn, role, row_number() over (partition by conv_id order by turn) - 1 as pos, count(*) over (partition by conv_id) as n from conversations),
s as (select distinct conv_id, n, unnest(range(0, (select max(n) from c))) as at from c)
select s.conv_id, s.at::bigint as pos, c.role, c.turn, s.at < s.n as valid from s join c on c.conv_id = s.conv_id and c.pos = least(s.at, s.n - 1)
""")
def to_dense(spark: SparkSession, sf: str) -> DataFrame:
    """Padded places repeat the last row."""
    return K.to_dense(table(spark, sf, "conversations").select("conv_id", "turn", "role"), "conv_id", "turn", ["role", "turn"])


@query(f"with {VOXELS} select ((b::bigint * 14 + (x + 2) // 4) * 4 + (y + 2) // 4) * 3 + (z + 2) // 4 as window, count(*)::bigint as n from v group by 1")
def window_partition(spark: SparkSession, sf: str) -> DataFrame:
    """Lengths of shifted windows (size 4, shift 2)."""
    return K.window_lengths(voxels(spark, sf), 4, 2, (51, 11, 9))


@query("with e as (select vec_id, label, round(embedding[1] * 1000)::bigint as v from embeddings) select vec_id, label, round((v - avg(v) over w) / stddev_pop(v) over w, 4) as normed from e window w as (partition by label)")
def segment_norm(spark: SparkSession, sf: str) -> DataFrame:
    """Normalisation inside each segment."""
    e = table(spark, sf, "embeddings").select("vec_id", "label", F.round(F.get("embedding", F.lit(0)).cast("double") * 1000).cast("long").alias("v"))
    return K.segment_norm(e, ["label"], "v").select("vec_id", "label", F.round("normed", 4).alias("normed"))


@query(f"with {VOXELS}, r as (select unnest([16, 24, 32, 40, 50])::int as res), c as (select res, count(distinct (b, trunc((x + 0.5) / 51 * res)::int, trunc((y + 0.5) / 51 * res)::int, trunc((z + 0.5) / 51 * res)::int)) as n from v, r group by 1) select coalesce(max(res) filter (n < 900), 16)::int as res, max_by(n, res) filter (n < 900)::bigint as n from c")
def token_budget(spark: SparkSession, sf: str) -> DataFrame:
    """The finest resolution below a budget of cells."""
    return K.token_budget(voxels(spark, sf), 51, [16, 24, 32, 40, 50], 900, 16)


@query("select (l_linenumber + 8 * (l_suppkey % 3))::int as b, count(*)::bigint as n from lineitem group by 1")
def union_renumber(spark: SparkSession, sf: str) -> DataFrame:
    """Three tables that hold all rows."""
    rows = table(spark, sf, "lineitem").select(F.col("l_linenumber").alias("b"), F.col("l_suppkey").alias("s"))
    return K.renumber_concat([rows.where(F.col("s") % 3 == i) for i in range(3)]).groupBy("b").agg(F.count("*").alias("n"))


@query(f"with {VOXELS} select 0 as b, x, y, z, n from v where b = 1 union all select 1, x, y, z, n from v where b = 0 union all select 2, x, y, z, n from v where b = 1")
def select_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Batches gathered by index, duplicates allowed."""
    return K.select_batches(voxels(spark, sf), [1, 0, 1]).select(*KEY, "n")


@query(f"with {VOXELS}, g as (select b::int as b, x::int as x, y::int as y, z::int as z from range(2) t(b), range(51) u(x), range(11) s(y), range(9) r(z)) select g.b, g.x, g.y, g.z, coalesce(v.n, 0)::bigint as n from g left join v using (b, x, y, z)")
def densify(spark: SparkSession, sf: str) -> DataFrame:
    """Every cell of the box."""
    return K.densify(voxels(spark, sf), 2, (51, 11, 9), "n")


@query(f"with {VOXELS} select a.x, a.y, a.z, a.p - c.p as p from v a join v c using (x, y, z) where a.b = 0 and c.b = 1")
def cellwise_difference(spark: SparkSession, sf: str) -> DataFrame:
    """Two tables aligned by coordinates."""
    v = voxels(spark, sf)
    one, two = v.where("b = 0"), v.where("b = 1").withColumn("b", F.lit(0))
    return K.combine(one, two, lambda a, b: a - b, "p").select("x", "y", "z", "p")


@query(f"with {VOXELS} select (max(x) + 1)::int as size_x, (max(y) + 1)::int as size_y, (max(z) + 1)::int as size_z from v")
def extents(spark: SparkSession, sf: str) -> DataFrame:
    return K.extents(voxels(spark, sf))


@query()
def window_attention(spark: SparkSession, sf: str) -> DataFrame:
    """Attention inside shifted windows of the voxels of each batch."""
    v = K.window_partition(voxels(spark, sf), 4, 2, (51, 11, 9))
    feats = F.array(*[(F.col(c) / 10).cast("double") for c in ("x", "y", "z", "n")])
    return K.attention(v.withColumn("f", feats), "window", "f", "f", "f", KEY).withColumn("out", F.transform("out", lambda x: F.round(x, 6)))


# --- curves and codecs ----------------------------------------------------------------------------------------------

_CODE = " + ".join(f"(((x >> {i}) & 1) << {3 * i + 2}) + (((y >> {i}) & 1) << {3 * i + 1}) + (((z >> {i}) & 1) << {3 * i})" for i in range(10))


@query(f"with {VOXELS} select b, x, y, z, ({_CODE})::bigint as code, x as dx, y as dy, z as dz from v")
def morton_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """codes and their decoding."""
    rows = voxels(spark, sf).select(*KEY, curves.z_order("x", "y", "z").alias("code"))
    return rows.withColumn("d", curves.z_order_decode("code")).select(*KEY, "code", F.col("d.x").alias("dx"), F.col("d.y").alias("dy"), F.col("d.z").alias("dz"))


@query()
def hilbert_codes(spark: SparkSession, sf: str) -> DataFrame:
    """codes and their decoding."""
    rows = voxels(spark, sf).select(*KEY, curves.hilbert("x", "y", "z").alias("code"))
    return rows.withColumn("d", curves.hilbert_decode("code")).select(*KEY, "code", (F.struct("x", "y", "z") == F.col("d")).alias("same"))


@query(f"with {VOXELS} select b, x, y, z, ((b::bigint * 51 + x) * 11 + y) * 9 + z as i from v")
def flat_index(spark: SparkSession, sf: str) -> DataFrame:
    i = curves.flat_index("b", "x", "y", "z", (51, 11, 9))
    rows = voxels(spark, sf).select(i.alias("i"))
    return rows.select(curves.flat_index_decode("i", (51, 11, 9)).alias("c"), "i").select("c.*", "i")


@query(f"with {VOXELS} select b, x, y, z, n from v where x between 10 and 25 and y between 2 and 6 and z between 0 and 3")
def box_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A covering set of code ranges, then the exact box."""
    rows = voxels(spark, sf).withColumn("code", curves.z_order("x", "y", "z"))
    return rows.where(curves.in_box("code", (10, 2, 0), (25, 6, 3), 2)).where("x between 10 and 25 and y between 2 and 6 and z between 0 and 3").select(*KEY, "n")


_LEVELS = " union all ".join(f"select b, {level} as level, (code >> {3 * (6 - level)})::bigint as node, bit_or(1 << ((code >> {3 * (5 - level)}) & 7))::int as mask from c group by 1, 2, 3" for level in range(6))


@query(f"with {VOXELS}, c as (select b, ({_CODE})::bigint as code from v) {_LEVELS}")
def octree_masks(spark: SparkSession, sf: str) -> DataFrame:
    """Child masks of every level of a tree of depth 6."""
    return codecs.octree_masks(voxels(spark, sf).select("b", curves.z_order("x", "y", "z").alias("code")), 6, by=["b"])


@query(f"with {VOXELS} select b, ({_CODE})::bigint as code from v")
def octree_leaves(spark: SparkSession, sf: str) -> DataFrame:
    """the leaves, decoded from the masks."""
    return codecs.octree_leaves(octree_masks(spark, sf), 6, by=["b"])


@query(f"""
with {VOXELS}, c as (select b, ({_CODE})::bigint as node, (p % 256)::int as value from v)
select b, 6 as level, node, value, case when lag(value) over w is null then value else ((value - lag(value) over w) % 256 + 256) % 256 end::int as delta from c window w as (partition by b, node >> 3 order by node)
""")
def sibling_delta(spark: SparkSession, sf: str) -> DataFrame:
    """Differences between neighbouring siblings modulo 256, at the leaves."""
    leaves = voxels(spark, sf).select("b", curves.z_order("x", "y", "z").alias("code"), (F.col("p") % 256).cast("int").alias("value"))
    return codecs.sibling_delta(leaves, 6, "value", by=["b"]).where("level = 6")


_BEFORE = " ".join(f"left join v n{i} on n{i}.b = v.b and n{i}.x = v.x - {o[0]} and n{i}.y = v.y - {o[1]} and n{i}.z = v.z - {o[2]}" for i, o in enumerate(codecs.PREDICTORS))
_BEST = "coalesce(" + ", ".join(f"n{i}.p % 256" for i in range(6, -1, -1)) + ", 0)"


@query(f"with {VOXELS} select v.b, v.x, v.y, v.z, (v.p % 256)::int as value, (((v.p % 256 - {_BEST}) % 256 + 256) % 256)::int as delta from v {_BEFORE}")
def neighbour_delta(spark: SparkSession, sf: str) -> DataFrame:
    """Differences to the last existing predictor of seven."""
    v = voxels(spark, sf).select(*KEY, (F.col("p") % 256).cast("int").alias("value"))
    return codecs.neighbour_delta(v, "value").withColumn("delta", F.col("delta").cast("int"))


@query(f"with {VOXELS}, c as (select x // 8 as cx, y // 8 as cy, z // 8 as cz, count(*)::bigint as n from v group by 1, 2, 3) select cx::int as cx, cy::int as cy, cz::int as cz, n, (dense_rank() over (order by cx, cy, cz) - 1)::bigint as i from c")
def chunk_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct chunks in order, numbered."""
    from lattica.operators.catalog import global_index

    chunks = codecs.chunked(voxels(spark, sf), 8).groupBy("cx", "cy", "cz").agg(F.count("*").alias("n"))
    return global_index(chunks, "cx", "cy", "cz")


_BITS = " + ".join(f"((i >> {k}) & 1) * {2.0 ** -(k + 1)}::double" for k in range(7))


@query(f"select i::bigint as i, round(({_BITS}) * 2 * pi(), 9) as yaw, round(acos(1 - 2 * (case when i / 64.0::double < 0.25 then i / 32.0::double else i / 64.0::double * 2 / 3 + 1 / 3.0::double end)) - pi() / 2, 9) as pitch from range(64) t(i)")
def view_sphere(spark: SparkSession, sf: str) -> DataFrame:
    """F32: views on a sphere."""
    rows = spark.range(64).select(F.col("id").alias("i"), scalars.sphere_view(F.col("id"), 64).alias("v"))
    return rows.select("i", F.round("v.yaw", 9).alias("yaw"), F.round("v.pitch", 9).alias("pitch"))


@query("select p_partkey, (2 ** case when p_size - 2 ** floor(log2(p_size)) < 2 ** (floor(log2(p_size)) + 1) - p_size then floor(log2(p_size)) else floor(log2(p_size)) + 1 end)::bigint as side from part where p_size >= 1")
def power_of_two(spark: SparkSession, sf: str) -> DataFrame:
    """F31."""
    return table(spark, sf, "part").where("p_size >= 1").select("p_partkey", geometry.nearest_power_of_two(F.col("p_size")).alias("side"))


@query("select l_orderkey, l_linenumber, (l_returnflag = 'R')::int + (l_linestatus = 'F')::int * 2 + (l_quantity > 25)::int * 4 as packed, l_returnflag = 'R' as a, l_linestatus = 'F' as b, l_quantity > 25 as c, trunc(greatest(least(l_discount * 12, 1), 0) * 255)::int as byte from lineitem")
def pack_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Three flags in one number and back; a clamped byte."""
    flags = [F.col("l_returnflag") == "R", F.col("l_linestatus") == "F", F.col("l_quantity") > 25]
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", scalars.pack_flags(*flags).alias("packed"), scalars.quantise_unit(F.col("l_discount") * 12).alias("byte"))
    u = scalars.unpack_flags(F.col("packed"))
    return rows.select("l_orderkey", "l_linenumber", "packed", u[0].alias("a"), u[1].alias("b"), u[2].alias("c"), "byte")
