"""Queries of functions and small operators that no other query reaches, and SQL for queries that run Python kernels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.functions import scalars as S
from lattica.operators import catalog as C
from lattica.operators import coords as K
from lattica.operators import geometry as G
from lattica.operators import sampling
from lattica.operators import telemetry as M
from lattica.plans.registry import ORACLES, query, table
from lattica.plans.spatial_queries import KEY, VOXELS, voxels


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem")


_LINE = ["l_orderkey", "l_linenumber"]


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Rounded, and -0.0 as 0.0."""
    return df.withColumns({n: F.round(n, digits) + F.lit(0.0) for n in names})


# --- predicates and selection ---------------------------------------------------------------------------------------


@query("""
select doc_id, quality is null as missing, true as absent, coalesce(quality = 1, false) or coalesce(toxic = 1, false) as any_flag, coalesce(quality > 0 and toxic > 0 and n_chars > 0, false) as full_texture
from documents left join labels using (doc_id)
""")
def flags_and_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Missing values and columns, an OR of flags, a conjunction of counts."""
    d = table(spark, sf, "documents").select("doc_id", "n_chars").join(table(spark, sf, "labels"), "doc_id", "left").withColumns({"q": F.col("quality") == 1, "t": F.col("toxic") == 1})
    return d.select("doc_id", C.missing(d, "quality").alias("missing"), C.missing(d, "nowhere").alias("absent"), C.any_flag("q", "t").alias("any_flag"), C.full_texture("quality", "toxic", "n_chars").alias("full_texture"))


@query("select p_partkey, p_size::bigint as size_256, p_size * 2::bigint as size_512, p_size::bigint as size from part")
def renamed_by_resolution(spark: SparkSession, sf: str) -> DataFrame:
    """P10: columns under a resolution's name, and back."""
    rows = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("long").alias("size"))
    fine = C.suffixed(rows.withColumn("size", F.col("size") * 2), ["size"], "512")
    both = C.suffixed(rows, ["size"], "256").join(fine, "p_partkey")
    return both.join(C.unsuffixed(C.suffixed(rows, ["size"], "256"), "256"), "p_partkey")


@query("select o_orderkey, o_totalprice from orders where o_orderkey in (select c_custkey from customer where c_custkey % 3 = 0) and o_orderkey not in (select p_partkey from part)")
def explicit_instances(spark: SparkSession, sf: str) -> DataFrame:
    """A list of instances bypasses the predicates, but not what is done."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    wanted = table(spark, sf, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("o_orderkey"))
    return C.worklist(orders, "o_orderkey", [F.lit(False)], wanted, table(spark, sf, "part").select(F.col("p_partkey").alias("o_orderkey")))


@query("""
select l_suppkey, coalesce(sum(nf) filter (nf > 0 and nv > 0), 0)::bigint as num_faces, coalesce(sum(nv) filter (nf > 0 and nv > 0), 0)::bigint as num_vertices, count(*) filter (l_linenumber % 2 = 0)::bigint as num_basecolor_tex,
    count(*) filter (l_linenumber % 3 = 0)::bigint as num_metallic_tex, 0::bigint as num_roughness_tex, count(*)::bigint as num_alpha_tex from (select *, l_linenumber % 4 as nf, l_linenumber as nv from lineitem) group by 1
""")
def asset_totals(spark: SparkSession, sf: str) -> DataFrame:
    """A3: faces, vertices and textures of nested dumps; objects without faces are left out."""
    n = F.col("l_linenumber")
    upto = lambda k: F.slice(F.sequence(F.lit(1), F.lit(9)), F.lit(1), k)
    one = F.struct(upto(n).alias("vertices"), upto(n % 4).alias("faces"))
    tex = lambda ok: F.when(ok, "t")
    material = F.struct(tex(n % 2 == 0).alias("baseColorTexture"), tex(n % 3 == 0).alias("metallicTexture"), tex(n < 0).alias("roughnessTexture"), tex(n > 0).alias("alphaTexture"))
    rows = _lines(spark, sf).groupBy("l_suppkey").agg(F.collect_list(one).alias("objects"), F.collect_list(material).alias("materials"))
    return C.asset_counts(rows).drop("objects", "materials")


@query("select p_partkey, [p_size % 3 - 1, p_size % 5, -1] as ids, [case when p_size % 3 = 0 then 5 else p_size % 3 - 1 end, p_size % 5, 5] as fixed from part")
def default_materials(spark: SparkSession, sf: str) -> DataFrame:
    """Material -1 is the last one."""
    ids = F.array(F.col("p_size") % 3 - 1, F.col("p_size") % 5, F.lit(-1))
    return table(spark, sf, "part").select("p_partkey", ids.alias("ids"), G.fix_materials(ids, F.lit(6)).alias("fixed"))


# --- coordinates ----------------------------------------------------------------------------------------------------


@query(f"with {VOXELS}, o(k, dx, dy, dz) as (values (0, -1, 0, 0), (1, 1, 0, 0), (2, 0, -1, 0), (3, 0, 1, 0), (4, 0, 0, -1), (5, 0, 0, 1)) select v.b, v.x, v.y, v.z, o.k, w.n as n_n from v, o join v w on w.b = v.b and w.x = v.x + dx and w.y = v.y + dy and w.z = v.z + dz")
def six_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """The cells across each of a cell's six faces."""
    return K.six_neighbours(voxels(spark, sf), ["n"])


@query(f"with {VOXELS}, a as (select * from v where n % 2 = 0), c as (select b, x, y, z, p as q from v where n % 3 = 0) select coalesce(a.b, c.b) as b, coalesce(a.x, c.x) as x, coalesce(a.y, c.y) as y, coalesce(a.z, c.z) as z, a.p, c.q from a full join c on a.b = c.b and a.x = c.x and a.y = c.y and a.z = c.z")
def aligned_sets(spark: SparkSession, sf: str) -> DataFrame:
    """Two voxel sets merged along the z-order curve."""
    v = voxels(spark, sf)
    return K.align_sorted(v.where("n % 2 = 0"), v.where("n % 3 = 0").withColumnRenamed("p", "q"), ["p"], ["q"])


@query("select true as same, false as other")
def equal_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Have two tables the same cells?"""
    v = voxels(spark, sf)
    return spark.createDataFrame([(K.same_cells(v, v.withColumn("n", F.lit(0))), K.same_cells(v, v.where("x > 3")))], "same boolean, other boolean")


@query(f"with {VOXELS} select b, x, y, z, [n::double, p::double] as feats from v")
def cell_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Batches taken apart, put together again, made dense and sparse."""
    v = voxels(spark, sf)
    parts = [v.where(F.col("b") == i).withColumn("b", F.lit(0)) for i in range(2)]
    whole = K.renumber_concat(parts)
    dense = K.densify(whole, 2, (51, 11, 9), "n")
    return K.sparsify(dense, "n").select(*KEY).join(whole, KEY).select(*KEY, K.cast_channels(F.array("n", "p"), "double").alias("feats"))


@query("select vec_id, list_transform([embedding[1:2], embedding[3:4], embedding[5:6], embedding[7:8]], lambda r: list_transform(r, lambda x: round(x * 1000)::bigint)) as rows from embeddings")
def channels_in_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Eight channels as four rows of two, cast to whole numbers."""
    f = F.transform(F.slice("embedding", 1, 8), lambda v: F.round(v * F.lit(1000.0).cast("float")))  # in single precision, as they are
    return table(spark, sf, "embeddings").select("vec_id", K.reshape(K.cast_channels(f, "bigint"), 2).alias("rows"))


@query(f"with {VOXELS}, m as (select b, max(n) as top from v group by 1) select v.b, x, y, z, [(n + top * 2)::double, (p + v.b * 3)::double] as feats from v join m on m.b = v.b")
def batch_operands(spark: SparkSession, sf: str) -> DataFrame:
    """P20: one operand for all rows of a batch."""
    v = voxels(spark, sf)
    own = v.groupBy("b").agg(F.max("n").alias("top")).select("b", F.array((F.col("top") * 2).cast("double"), (F.col("b") * 3).cast("double")).alias("operand"))
    return K.batch_operand(v.select(*KEY, F.array(F.col("n").cast("double"), F.col("p").cast("double")).alias("feats")), own, lambda a, b: a + b)


@query("select event_id, event_id % 5 <> 0 and event_id % 7 <> 0 as finite, least(event_id % 11, 5) / 10.0::double as inside from events")
def finite_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Finite features, and a range that is asserted."""
    e = F.col("event_id")
    feats = F.array(F.when(e % 5 == 0, float("nan")).otherwise(1.0), F.when(e % 7 == 0, float("inf")).otherwise(2.0))
    return table(spark, sf, "events").select("event_id", S.all_finite(feats).alias("finite"), S.in_range(F.least(e % 11, F.lit(5)) / 10, 0.0, 0.5, 1e-3).alias("inside"))


@query("select vec_id, [round((embedding[1] + embedding[2]) / 2, 5), round((embedding[3] + embedding[4]) / 2, 5)] as folded, [round(embedding[1], 5), round(embedding[1], 5), round(embedding[2], 5), round(embedding[2], 5)] as repeated from (select vec_id, list_transform(embedding, lambda x: x::double) as embedding from embeddings)")
def channel_folds(spark: SparkSession, sf: str) -> DataFrame:
    """channels folded into means of two, and each repeated twice."""
    f = F.transform("embedding", lambda v: v.cast("double"))
    r = lambda c: F.transform(c, lambda v: S.round_signed(v, 5))
    return table(spark, sf, "embeddings").select("vec_id", r(K.fold_channels(F.slice(f, 1, 4), 2, 2)).alias("folded"), r(K.repeat_channels(F.slice(f, 1, 2), 2)).alias("repeated"))


# --- hashes, grids, geometry ----------------------------------------------------------------------------------------

_XOR = "xor({a}, {a} >> {n})"
_M32 = "(({a})::hugeint * {m} % 4294967296)::bigint"


@query(f"""
with k as (select l_orderkey, l_linenumber, (l_orderkey * 131 + l_partkey) % 4294967296 as k, l_quantity::bigint as x, l_orderkey % 1024 as y, l_partkey % 1024 as z from lineitem),
a as (select *, {_M32.format(a="xor(k, k >> 16)", m=2246822507)} as h from k), b as (select *, {_M32.format(a="xor(h, h >> 13)", m=3266489909)} as g from a)
select l_orderkey, l_linenumber, xor(g, g >> 16) as murmur, xor(xor(x * 73856093, y * 19349663), z * 83492791) % 1000003 as slot from b
""")
def hash_functions(spark: SparkSession, sf: str) -> DataFrame:
    """a finaliser and a spatial hash."""
    rows = _lines(spark, sf)
    k = F.pmod(F.col("l_orderkey") * 131 + F.col("l_partkey"), F.lit(1 << 32))
    slot = S.spatial_hash(F.col("l_quantity").cast("long"), F.col("l_orderkey") % 1024, F.col("l_partkey") % 1024, 1000003)
    return rows.select(*_LINE, S.murmur_finaliser(k).alias("murmur"), slot.cast("long").alias("slot"))


@query("""
with p as (select p_partkey, 0.0::double as low, p_size / 10.0::double + 0.03 as high from part), g as (select *, ceil(high / 0.25 - 1e-12)::int as size from p)
select p_partkey, size, round(low - (size * 0.25 - high) / 2, 9) as low, round(high + (size * 0.25 - high) / 2, 9) as high, round(high / 32, 9) as voxel from g
""")
def grid_parameters(spark: SparkSession, sf: str) -> DataFrame:
    """a grid's size from its voxels, padded on both sides, and the voxels of a given size; per distinct part size."""
    sizes = table(spark, sf, "part").select("p_size").distinct().collect()  # as many as the column has values, 50 at most
    made = []
    for (n,) in sizes:
        high = n / 10.0 + 0.03
        low, top, _, size = G.resolve_grid([0.0], [high], voxel=0.25)
        made.append((n, size[0], round(low[0], 9) + 0.0, round(top[0], 9), round(G.resolve_grid([0.0], [high], grid=32)[2][0], 9)))
    known = spark.createDataFrame(made, "p_size int, size int, low double, high double, voxel double")
    return table(spark, sf, "part").select("p_partkey", "p_size").join(known, "p_size").drop("p_size")


@query("select l_orderkey, l_linenumber, round(greatest(least(-(l_discount * 10 - 0.5), 0.5), -0.5), 9) + 0.0 as x, round(greatest(least(l_tax * 10 - 0.5, 0.5), -0.5), 9) + 0.0 as y, round(greatest(least(l_quantity / 50 - 0.5, 0.5), -0.5), 9) + 0.0 as z from lineitem")
def rotated_vertices(spark: SparkSession, sf: str) -> DataFrame:
    """a quarter turn, clipped to the cube."""
    rows = _lines(spark, sf).select(*_LINE, (F.col("l_tax") * 10 - 0.5).alias("x"), (F.col("l_discount") * 10 - 0.5).alias("y"), (F.col("l_quantity") / 50 - 0.5).alias("z"))
    return _rounded(G.rotate_clip(rows, ((0.0, -1.0, 0.0), (1.0, 0.0, 0.0), (0.0, 0.0, 1.0))), 9, "x", "y", "z")


@query("""
with e as (select event_id, (event_id % 97 + 0.5) / 97::double as u, (event_id % 13 + 1)::double as x, (event_id % 17 + 2)::double as y, (event_id % 19)::double as z from events),
c as (select *, 1 / sqrt(u * (1 / 4.0::double - 1 / 25.0::double) + 1 / 25.0::double) as r, sqrt(x * x + y * y + z * z) as l, sqrt(x * x + y * y) as h from e)
select event_id, round(r, 8) as radius, round(asin(sqrt(3) / 2 / r) * 2, 8) as fov, round(1 / tan(asin(sqrt(3) / 2 / r)), 8) as focal, round(-y / h, 8) + 0.0 as rx, round(x / h, 8) + 0.0 as ry, round(l, 8) as depth, round(-(x + 2 * y), 8) as t0 from c
""")
def camera_matrices(spark: SparkSession, sf: str) -> DataFrame:
    """radii even in 1 / r^2 with their field of view, look-at rows, a projection, a rigid inverse."""
    e = F.col("event_id")
    eye = [(e % 13 + 1).cast("double"), (e % 17 + 2).cast("double"), (e % 19).cast("double")]
    rows = table(spark, sf, "events").select("event_id", S.camera((e % 97 + 0.5) / 97, 2.0, 5.0).alias("c"), S.look_at(eye).alias("m"), F.array(*eye).alias("eye"))
    rigid = F.array(*[F.array(*[F.lit(float(i == j)) for j in range(3)], F.get("eye", F.lit(i))) for i in range(3)], F.array(*[F.lit(v) for v in (0.0, 0.0, 0.0, 1.0)]))
    inverse = S.inverse_rigid(rigid)
    depth = F.get("m", F.lit(11))
    t = F.get(F.get(inverse, F.lit(0)), F.lit(3)) + F.get(F.get(inverse, F.lit(1)), F.lit(3)) * 2
    out = rows.select(
        "event_id", F.col("c.radius").alias("radius"), F.col("c.fov").alias("fov"), F.get(S.projection(F.col("c.fov"), 0.1, 10.0), F.lit(0)).alias("focal"),
        F.get("m", F.lit(0)).alias("rx"), F.get("m", F.lit(1)).alias("ry"), depth.alias("depth"), t.alias("t0"),
    )
    return _rounded(out, 8, "radius", "fov", "focal", "rx", "ry", "depth", "t0")


@query("select l_orderkey, l_linenumber, trunc(greatest(least(l_quantity * 0.03 / 0.25 - floor(l_quantity * 0.03 / 0.25 / 1.25), 1), 0) * 255)::int as byte, round((floor(l_quantity / 4) + l_discount) * 0.25 - 0.5, 9) as place from lineitem")
def dual_places(spark: SparkSession, sf: str) -> DataFrame:
    """a dual vertex's byte inside its cell, and its place in the world."""
    v = F.col("l_quantity") * 0.03
    cell = F.floor(v / 0.25 / 1.25)
    return _lines(spark, sf).select(*_LINE, G.quantise_dual(v, cell, 0.25).alias("byte"), F.round(G.dual_position(F.floor(F.col("l_quantity") / 4), F.col("l_discount"), 0.25, -0.5), 9).alias("place"))


@query("""
with q as (select l_orderkey, l_linenumber, l_quantity as a, l_discount * 10 as s, l_tax * 10 as t from lineitem),
d as (select *, (0.5 * 0.75 - s * t) as det from q), e as (select *, sqrt((0.75 * a) ** 2 + s ** 2) as tl, sqrt((t * a) ** 2 + 0.25) as bl from d)
select l_orderkey, l_linenumber, case when abs(det) < 1e-6 then 1 else round(0.75 * a / tl, 7) end as tx, case when abs(det) < 1e-6 then 0 else round(-s / tl, 7) + 0.0 end as ty,
    case when abs(det) < 1e-6 then 1e6 else round(tl / det, 4) end as mu, case when abs(det) < 1e-6 then 1e6 else round(bl / det, 4) end as mv from e
""")
def tangent_frames(spark: SparkSession, sf: str) -> DataFrame:
    """tangents and texture footprints of triangles (0, 0, 0), (a, 0, 0), (0, 1, 0)."""
    zero, one = F.lit(0.0), F.lit(1.0)
    corners = dict(zip([f"{c}{k}" for c in "abc" for k in "xyz"], (zero, zero, zero, F.col("l_quantity"), zero, zero, zero, one, zero), strict=True))
    uv = dict(zip(("au", "av", "bu", "bv", "cu", "cv"), (zero, zero, F.lit(0.5), F.col("l_discount") * 10, F.col("l_tax") * 10, F.lit(0.75)), strict=True))
    rows = _lines(spark, sf).select(*_LINE, *[c.alias(n) for n, c in (corners | uv).items()])
    frame = G.tangent_frame()
    out = rows.select(*_LINE, *[frame[n].alias(n) for n in ("tx", "ty", "mu", "mv")])
    return _rounded(_rounded(out, 7, "tx", "ty"), 4, "mu", "mv")


@query("""
with s as (select l_orderkey, l_linenumber, l_discount * 20 - 1 as x, l_tax * 20 - 1 as y, l_quantity / 25 - 1 as z from lineitem), n as (select *, sqrt(x * x + y * y + z * z) as l from s)
select l_orderkey, l_linenumber, round(x / case when l > 0 then l else 1 end, 7) + 0.0 as nx, round(z / case when l > 0 then l else 1 end, 7) + 0.0 as ny, round(y / case when l > 0 then l else 1 end, 7) + 0.0 as nz from n
""")
def decoded_normals(spark: SparkSession, sf: str) -> DataFrame:
    """a normal map's samples in the frame (x, z, y)."""
    lit = lambda *v: tuple(map(F.lit, v))
    sample = (F.col("l_discount") * 10, F.col("l_tax") * 10, F.col("l_quantity") / 50)
    got = G.decode_normal(sample, lit(1.0, 0.0, 0.0), lit(0.0, 0.0, 1.0), lit(0.0, 1.0, 0.0))
    return _rounded(_lines(spark, sf).select(*_LINE, *[c.alias(n) for n, c in zip(("nx", "ny", "nz"), got, strict=True)]), 7, "nx", "ny", "nz")


@query("select event_id, least((event_id % 300 + 1) / 200.0::double, 1.0) as rate, round(greatest(least(value / 50 - 1, 1), -1), 7) + 0.0 as held from events")
def warm_up_rates(spark: SparkSession, sf: str) -> DataFrame:
    """F44 and clipping."""
    rows = table(spark, sf, "events").select("event_id", S.warm_up(F.col("event_id") % 300, 200).alias("rate"), S.clip(F.col("value") / 50 - 1, -1.0, 1.0).alias("held"))
    return _rounded(rows, 7, "held")


@query("select c_custkey, c_mktsegment as segment, (c_custkey % 2 = 0)::varchar as even, null::varchar as nothing from customer")
def dict_literals(spark: SparkSession, sf: str) -> DataFrame:
    """values of Python dict literals in a text column."""
    text = F.format_string("{'segment': '%s', 'even': %s, 'nothing': None}", "c_mktsegment", F.when(F.col("c_custkey") % 2 == 0, "True").otherwise("False"))
    rows = table(spark, sf, "customer").select("c_custkey", text.alias("t"))
    return rows.select("c_custkey", *[S.python_dict_value(F.col("t"), k).alias(k) for k in ("segment", "even", "nothing")])


# --- sampling and telemetry -----------------------------------------------------------------------------------------


@query("select s_suppkey, floor(s_suppkey * 37 / 100)::bigint as epoch, (s_suppkey * 37 % 100)::bigint as idx from supplier")
def sampler_states(spark: SparkSession, sf: str) -> DataFrame:
    """A sampler's state after so many rows, through save and load."""
    from lattica.session import scratch

    path = scratch(spark, "sampler")
    sampling.SamplerState(100).advance(37).save(spark, path)
    one = sampling.SamplerState.load(spark, path, 100)
    steps = sorted(r[0] for r in table(spark, sf, "supplier").select("s_suppkey").collect())  # suppliers stand for steps
    made, now, at = [], sampling.SamplerState(100, one.epoch, one.idx), 1
    for step in steps:
        now, at = now.advance(37 * (step - at)), step
        made.append((step, now.epoch, now.idx))
    return spark.createDataFrame(made, "s_suppkey long, epoch long, idx long")


@query("with d as (select doc_id, row_number() over (order by doc_id) - 1 as i, count(*) over () as n from documents) select doc_id, floor(((i + 1) * 6 - 1) / n)::int as part from d")
def even_slices(spark: SparkSession, sf: str) -> DataFrame:
    """A batch in six even slices."""
    docs = C.global_index(table(spark, sf, "documents").select("doc_id"), "doc_id")
    n = docs.agg(F.count("*").alias("n"))
    return sampling.even_split(docs.crossJoin(F.broadcast(n)), "i", F.col("n"), 6).select("doc_id", "part")  # n: one row


def _balanced_sql(items: str, key: str, groups: int, equal: bool, out: str) -> str:
    """items(batch, item, load, ord): heaviest first into the least loaded group that has room, one step of a recursion per item."""
    zeros = "[" + ", ".join(["0"] * groups) + "]"
    share = f"(case when i.n // {groups} > 0 and i.r <= i.n // {groups} * {groups} then i.n // {groups} when i.n // {groups} * {groups} = i.n then i.n // {groups} else i.n // {groups} + 1 end)" if equal else "i.n + 1"
    open_ = f"list_transform(range(1, {groups + 1}), lambda g: case when s.held[g] < {share} then s.total[g]::double else 1e300 end)"
    return f"""
with recursive {items}, i as (select *, row_number() over (partition by batch order by load desc, ord desc) as r, count(*) over (partition by batch) as n from items),
s as (
    select distinct batch, 0::bigint as r, {zeros}::bigint[] as total, {zeros}::bigint[] as held, null::bigint as item, null::int as g from i
    union all
    select batch, r, list_transform(range(1, {groups + 1}), lambda j: total[j] + case when j = g then load else 0 end)::bigint[], list_transform(range(1, {groups + 1}), lambda j: held[j] + case when j = g then 1 else 0 end)::bigint[], item, g
    from (select i.batch, i.r, s.total, s.held, i.item, i.load, list_position({open_}, list_min({open_}))::int as g from s join i on i.batch = s.batch and i.r = s.r + 1)
)
select i.*, (s.g - 1)::int as {out} from i join s on s.batch = i.batch and s.r = i.r"""


_DOC_ITEMS = "items as (select doc_id // 64 as batch, doc_id as item, n_chars as load, doc_id as ord from documents)"
ORACLES["balanced_groups"] = f"select item as doc_id, load as n_chars, batch, \"group\" from ({_balanced_sql(_DOC_ITEMS, 'doc_id', 8, True, chr(34) + 'group' + chr(34))})"


@query(f"select item as doc_id, load as n_chars, batch, micro from ({_balanced_sql(_DOC_ITEMS, 'doc_id', 4, False, 'micro')})")
def micro_batches(spark: SparkSession, sf: str) -> DataFrame:
    """A batch split by load."""
    docs = table(spark, sf, "documents").select("doc_id", "n_chars", F.floor(F.col("doc_id") / 64).alias("batch"))
    return sampling.micro_batches(docs, "batch", "doc_id", "n_chars", 4)


_EPOCH_ITEMS = """o as (select doc_id, n_chars, row_number() over (order by md5('42:' || doc_id::varchar), doc_id) - 1 as i, count(*) over () as n from documents),
e as (select doc_id, n_chars, i, n from o union all select doc_id, n_chars, i + n, n from o where i < (4 - n % 4) % 4),
items as (select i // 32 as batch, doc_id as item, n_chars as load, i as ord from e where i < (n + 3) // 4 * 4 // 32 * 32)"""
ORACLES["balanced_sampler"] = f"select item as doc_id, load as n_chars, ord as i, batch as macro, rank from ({_balanced_sql(_EPOCH_ITEMS, 'doc_id', 4, True, 'rank')})"


@query("select event_type || '/' || user_id::varchar as key, round(sum(value), 6) as value from events where event_type < 'm' group by 1 union all select event_type || '/' || user_id::varchar, round(max(value), 6) from events where event_type >= 'm' group by 1")
def disjoint_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Two sets of metrics without a common leaf."""
    rows = table(spark, sf, "events").select(F.concat_ws("/", "event_type", F.col("user_id").cast("string")).alias("key"), "value", "event_type")
    low = rows.where("event_type < 'm'").groupBy("key").agg(F.round(F.sum("value"), 6).alias("value"))
    return M.merge_disjoint(low, rows.where("event_type >= 'm'").groupBy("key").agg(F.round(F.max("value"), 6).alias("value")), "key", "value")


# --- SQL of kernels in Python ---------------------------------------------------------------------------------------

_F4 = "[x / 10.0::double, y / 10.0::double, z / 10.0::double, n / 10.0::double]"


def _attended(queries: str, keys: str, on: str, head: str) -> str:
    """softmax(q k^T / 2) v of four channels over the pairs that `on` allows."""
    s = "(" + " + ".join(f"q.f[{i}] * k.f[{i}]" for i in range(1, 5)) + ") / 2"
    total = ", ".join(f"round(sum(e * v[{i}]) / sum(e), 6)" for i in range(1, 5))
    return f"s as (select {head}, k.f as v, {s} as s from {queries} q join {keys} k on {on}), m as (select *, exp(s - max(s) over (partition by {head.replace('q.', '')})) as e from s) select {head.replace('q.', '')}, [{total}] as out from m group by all"


ORACLES["window_attention"] = f"with {VOXELS}, w as (select *, ((b::bigint * 14 + (x + 2) // 4) * 4 + (y + 2) // 4) * 3 + (z + 2) // 4 as win, {_F4} as f from v), " + _attended("w", "w", "q.win = k.win", "q.b, q.x, q.y, q.z, q.win").replace("select b, x, y, z, win, [", 'select b, x, y, z, win as "window", [')


@query(f"with {VOXELS}, w as (select b * 9 + z as g, x, y, {_F4} as f from v), " + _attended("(select * from w where x % 3 = 0)", "(select * from w where x % 5 = 1)", "q.g = k.g", "q.g, q.x, q.y"))
def cross_attended(spark: SparkSession, sf: str) -> DataFrame:
    """Queries of one table over keys and values of another, whole batch elements."""
    v = voxels(spark, sf).select((F.col("b") * 9 + F.col("z")).alias("g"), "x", "y", F.array(*[(F.col(c) / 10).cast("double") for c in ("x", "y", "z", "n")]).alias("f"))
    got = K.cross_attention(v.where("x % 3 = 0"), v.where("x % 5 = 1"), "g", "f", "f", "f", ["x", "y"])
    return got.withColumn("out", F.transform("out", lambda x: F.round(x, 6)))


@query(f"with {VOXELS}, w as (select b * 9 + z as g, x, y, {_F4} as f from v), " + _attended("w", "w", "q.g = k.g", "q.g, q.x, q.y"))
def full_attended(spark: SparkSession, sf: str) -> DataFrame:
    """Whole batch elements over themselves."""
    v = voxels(spark, sf).select((F.col("b") * 9 + F.col("z")).alias("g"), "x", "y", F.array(*[(F.col(c) / 10).cast("double") for c in ("x", "y", "z", "n")]).alias("f"))
    return K.attention(v, "g", "f", "f", "f", ["x", "y"]).withColumn("out", F.transform("out", lambda x: F.round(x, 6)))


ORACLES["segment_group_norm"] = """
with e as (select vec_id, label, unnest(range(1, len(embedding) + 1)) as c, unnest(embedding)::double as v from embeddings),
s as (select label, (c - 1) // 4 as g, avg(v) as m, var_pop(v) as s from e group by 1, 2)
select vec_id, label, list(round((v - m) / sqrt(s + 1e-5::double), 6) order by c) as f from e join s using (label) where s.g = (c - 1) // 4 group by 1, 2
"""

ORACLES["image_similarity"] = """
with p as (select l_linestatus, l_partkey % 16 as px, l_suppkey % 16 as py, avg(l_discount * 10) as a, avg(l_tax * 12) as b from lineitem group by 1, 2, 3),
g as (select i, exp(-((i - 5) * (i - 5)) / 4.5::double) as g from range(11) t(i)), k as (select x.i - 5 as dx, y.i - 5 as dy, x.g * y.g / ((select sum(g) from g) ** 2) as w from g x, g y),
m as (select c.l_linestatus, c.px, c.py, sum(w * n.a) as mx, sum(w * n.b) as my, sum(w * n.a * n.a) as xx, sum(w * n.b * n.b) as yy, sum(w * n.a * n.b) as xy
    from p c, k join p n on n.l_linestatus = c.l_linestatus and n.px = c.px - dx and n.py = c.py - dy group by 1, 2, 3)
select l_linestatus, round(avg(((2 * mx * my + 0.0001) * (2 * (xy - mx * my) + 0.0009)) / ((mx * mx + my * my + 0.0001) * (xx - mx * mx + yy - my * my + 0.0009))), 8) as ssim from m group by 1
"""


def _hilbert_sql() -> str:
    """The ten-bit curve by its published recurrence (inverse undo, then Gray encoding), one step a subquery."""
    now, n = "v", 0
    out = []

    def step(columns: str) -> None:
        nonlocal now, n
        out.append(f"h{n} as (select b, x, y, z, {columns} from {now})")
        now, n = f"h{n}", n + 1

    step("x::bigint as a0, y::bigint as a1, z::bigint as a2")
    for q in (1 << k for k in range(9, 0, -1)):
        low = q - 1
        step(f"case when a0 & {q} <> 0 then xor(a0, {low}) else a0 end as a0, a1, a2")
        for i in (1, 2):
            swap = f"(xor(a0, a{i}) & {low})"
            kept = ", ".join(f"case when a{i} & {q} <> 0 then a{i} else xor(a{i}, {swap}) end as a{j}" if j == i else f"a{j}" for j in (1, 2))
            step(f"case when a{i} & {q} <> 0 then xor(a0, {low}) else xor(a0, {swap}) end as a0, {kept}")
    step("a0, xor(a1, a0) as a1, xor(a2, xor(a1, a0)) as a2")
    turn = "0::bigint"
    for q in (1 << k for k in range(9, 0, -1)):
        turn = f"xor({turn}, case when a2 & {q} <> 0 then {q - 1} else 0 end)"
    step(f"xor(a0, {turn}) as a0, xor(a1, {turn}) as a1, xor(a2, {turn}) as a2")
    code = " + ".join(f"(((a0 >> {k}) & 1) << {3 * k + 2}) + (((a1 >> {k}) & 1) << {3 * k + 1}) + (((a2 >> {k}) & 1) << {3 * k})" for k in range(10))
    return f"with {VOXELS}, {', '.join(out)} select b, x, y, z, ({code})::bigint as code, true as same from {now}"


ORACLES["hilbert_codes"] = _hilbert_sql()
