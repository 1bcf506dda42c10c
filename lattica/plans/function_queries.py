"""Queries of scalar, array and vector functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.functions import scalars as S
from lattica.operators import coords as K
from lattica.operators import geometry as G
from lattica.operators import telemetry as M
from lattica.plans.registry import query, table
from lattica.plans.spatial_queries import VOXELS, voxels


def _round(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


@query(f"with {VOXELS} select distinct b, x // 4 as x, y // 4 as y, z // 4 as z from v")
def occupancy(spark: SparkSession, sf: str) -> DataFrame:
    """A coarser occupancy grid."""
    return K.occupancy(voxels(spark, sf), 4)


@query("with e as (select vec_id, list_transform(embedding[1:8], lambda v: round(v * 1000)::bigint) as f from embeddings) select vec_id, list_sum(f)::bigint as total, [f[1] * 3 - f[2], f[2] * 3 - f[3]] as mixed, list_max(f)::bigint as top, f[3:4] as part from e")
def channel_functions(spark: SparkSession, sf: str) -> DataFrame:
    """Channels sliced, summed and combined."""
    f = F.transform(F.slice("embedding", 1, 8), lambda v: F.round(v * F.lit(1000.0).cast("float")).cast("long"))  # in single precision, as they are
    e = table(spark, sf, "embeddings").select("vec_id", f.alias("f"))
    mixed = K.zip_op(F.slice("f", 1, 2), F.slice("f", 2, 2), lambda a, b: a * 3 - b)
    total = F.aggregate("f", F.lit(0).cast("long"), lambda s, v: s + v)
    return e.select("vec_id", total.alias("total"), mixed.alias("mixed"), F.array_max("f").alias("top"), K.channels(F.col("f"), {"a": (0, 2), "b": (2, 4)}, "b").alias("part"))


@query("select vec_id, round((embedding[1] - 0.25) / 0.5, 5) as a, round((embedding[2] + 0.5) / 2, 5) as b from embeddings")
def normalise_channels(spark: SparkSession, sf: str) -> DataFrame:
    """P21."""
    f = K.normalise(F.transform(F.slice("embedding", 1, 2), lambda v: v.cast("double")), [0.25, -0.5], [0.5, 2.0])
    return _round(table(spark, sf, "embeddings").select("vec_id", f.alias("f")).select("vec_id", F.get("f", F.lit(0)).alias("a"), F.get("f", F.lit(1)).alias("b")), 5, "a", "b")


@query("""
with p as (select l_orderkey, l_linenumber, l_discount as x, l_tax as e, l_quantity / 50 as t from lineitem)
select l_orderkey, l_linenumber, round((1 - t) * x + (0.1 + 0.9 * t) * e, 9) as xt, round(0.9 * e - x, 9) as v, round(x * 3 - e * 2, 9) as guided, round(t * 3 / (1 + 2 * t), 9) as warped, round(1 / (1 + exp(-(t * 2 + 0.5))), 9) as lognormal from p
""")
def flow_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Diffusion paths, velocities, guidance and time maps."""
    x, e, t = F.array("l_discount"), F.array("l_tax"), F.col("l_quantity") / 50
    one = lambda c: F.get(c, F.lit(0))
    out = {"xt": one(S.diffuse(x, e, t, 0.1)), "v": one(S.velocity(x, e, 0.1)), "guided": one(S.guide(x, e, 3.0)), "warped": S.rescale_time(t, 3.0), "lognormal": S.logit_normal(t, 0.5, 2.0)}
    return _round(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *[c.alias(n) for n, c in out.items()]), 9, *out)


@query("select event_id, round(cos(event_id % 50), 9) as c0, round(sin(event_id % 50), 9) as s0, round(cos((event_id % 50) * pow(10000.0::double, -0.5)), 9) as c1, round(sin((event_id % 50) * pow(10000.0::double, -0.5)), 9) as s1 from events")
def rotary_phases(spark: SparkSession, sf: str) -> DataFrame:
    """F37, F38."""
    p = S.rotary_phases(F.col("event_id") % 50, 2)
    rows = table(spark, sf, "events").select("event_id", p.alias("p"))
    at = lambda i, f: F.get("p", F.lit(i))[f]
    return _round(rows.select("event_id", at(0, "cos").alias("c0"), at(0, "sin").alias("s0"), at(1, "cos").alias("c1"), at(1, "sin").alias("s1")), 9, "c0", "s0", "c1", "s1")


@query("""
with p as (select l_orderkey, l_linenumber, l_discount * 20 as c, l_tax as d from lineitem)
select l_orderkey, l_linenumber, round(greatest(least((c * (2.51 * c + 0.03)) / (c * (2.43 * c + 0.59) + 0.14), 1), 0), 9) as tone, round(abs(c - d) / greatest(abs(c), abs(d), 1e-12), 9) as rel, round(pow(greatest(least(d, 1), 0), 1 / 2.2), 9) as gam, round(d / 255 * 2 - 1, 9) as signed from p
""")
def tone_and_errors(spark: SparkSession, sf: str) -> DataFrame:
    """F43, F45, P22."""
    c, d = F.col("l_discount") * 20, F.col("l_tax")
    out = {"tone": S.tone_map(c), "rel": S.rel_error(c, d), "gam": S.gamma(d), "signed": S.to_signed_unit(d)}
    return _round(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *[v.alias(n) for n, v in out.items()]), 9, *out)


_VERTS = "v as (select l_suppkey as mesh, l_orderkey * 10 + l_linenumber as vid, l_quantity as x, l_discount * 100 as y, l_tax * 100 as z from lineitem)"


def _vertices(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("mesh"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("vid"), F.col("l_quantity").alias("x"), (F.col("l_discount") * 100).alias("y"), (F.col("l_tax") * 100).alias("z")
    )


@query(f"""
with {_VERTS}, b as (select mesh, (min(x) + max(x)) / 2 as cx, (min(y) + max(y)) / 2 as cy, (min(z) + max(z)) / 2 as cz, greatest(max(x) - min(x), max(y) - min(y), max(z) - min(z)) as e from v group by 1)
select mesh, vid, round((x - cx) * 0.99999 / e, 7) as x, round((y - cy) * 0.99999 / e, 7) as y, round((z - cz) * 0.99999 / e, 7) as z from v join b using (mesh)
""")
def normalise_mesh(spark: SparkSession, sf: str) -> DataFrame:
    """Vertices scaled into the unit cube."""
    return _round(G.normalise_vertices(_vertices(spark, sf)), 7, "x", "y", "z")


_FACES = "t as (select l_orderkey, l_linenumber, l_quantity as ax, l_discount * 100 as ay, l_tax * 100 as az, l_quantity + 1 as bx, l_tax * 50 as b_y, 2.0::double as bz, 3.0::double as cx, l_quantity as cy, l_discount * 10 as cz from lineitem)"


def _faces(spark: SparkSession, sf: str) -> DataFrame:
    q, d, t = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")
    cells = {"ax": q, "ay": d * 100, "az": t * 100, "bx": q + 1, "by": t * 50, "bz": F.lit(2.0), "cx": F.lit(3.0), "cy": q, "cz": d * 10}
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *[c.alias(n) for n, c in cells.items()])


_CROSS = "(b_y - ay) * (cz - bz) - (bz - az) * (cy - b_y) as nx, (bz - az) * (cx - bx) - (bx - ax) * (cz - bz) as ny, (bx - ax) * (cy - b_y) - (b_y - ay) * (cx - bx) as nz"


@query(f"with {_FACES}, n as (select *, {_CROSS} from t), u as (select *, sqrt(nx * nx + ny * ny + nz * nz) as l from n) select l_orderkey, l_linenumber, round(nx / case when l > 0 then l else 1 end, 7) + 0.0::double as nx, round(ny / case when l > 0 then l else 1 end, 7) + 0.0::double as ny, round(nz / case when l > 0 then l else 1 end, 7) + 0.0::double as nz, round(-(nx * ax + ny * ay + nz * az) / case when l > 0 then l else 1 end, 5) + 0.0::double as nd from u")
def face_planes(spark: SparkSession, sf: str) -> DataFrame:
    """Unit normals and plane offsets of triangles."""
    rows = G.with_normals(_faces(spark, sf)).select("l_orderkey", "l_linenumber", "nx", "ny", "nz", "nd")
    return _round(_round(rows, 7, "nx", "ny", "nz"), 5, "nd").withColumns({c: F.col(c) + F.lit(0.0) for c in ("nx", "ny", "nz", "nd")})


@query(f"""
with {_FACES}, n as (select *, (bx - ax) as abx, (b_y - ay) as aby, (bz - az) as abz, (cx - ax) as acx, (cy - ay) as acy, (cz - az) as acz, (1.0 - ax) as px, (2.0 - ay) as py, (3.0 - az) as pz from t),
d as (select *, abx * abx + aby * aby + abz * abz as d00, abx * acx + aby * acy + abz * acz as d01, acx * acx + acy * acy + acz * acz as d11, px * abx + py * aby + pz * abz as d20, px * acx + py * acy + pz * acz as d21 from n)
select l_orderkey, l_linenumber, round((d11 * d20 - d01 * d21) / (d00 * d11 - d01 * d01), 5) as v, round((d00 * d21 - d01 * d20) / (d00 * d11 - d01 * d01), 5) as w from d where d00 * d11 - d01 * d01 > 1
""")
def barycentric_coordinates(spark: SparkSession, sf: str) -> DataFrame:
    """barycentric coordinates of the point (1, 2, 3) projected to each triangle."""
    rows = _faces(spark, sf).withColumns({"px": F.lit(1.0), "py": F.lit(2.0), "pz": F.lit(3.0)})
    a, b, c = G.corners()
    ab, ac = G.minus(b, a), G.minus(c, a)
    rows = rows.withColumn("area", G.dot(ab, ab) * G.dot(ac, ac) - G.dot(ab, ac) * G.dot(ab, ac)).where("area > 1")
    got = G.barycentric(G.vector("px", "py", "pz"), G.vector("nx", "ny", "nz"))
    rows = G.with_normals(rows)
    return _round(rows.select("l_orderkey", "l_linenumber", got["v"].alias("v"), got["w"].alias("w")), 5, "v", "w")


@query("select user_id, bool_and(value > 1) as all_large, bool_or(value > 99) as any_huge from events group by 1")
def any_and_all(spark: SparkSession, sf: str) -> DataFrame:
    """A22."""
    return table(spark, sf, "events").groupBy("user_id").agg(F.bool_and(F.col("value") > 1).alias("all_large"), F.bool_or(F.col("value") > 99).alias("any_huge"))


@query(f"with {VOXELS} select b, x, y, z, trunc((x + 0.5) / 51 * 16)::int as rx, trunc((y + 0.5) / 51 * 16)::int as ry, trunc((z + 0.5) / 51 * 16)::int as rz from v")
def requantise(spark: SparkSession, sf: str) -> DataFrame:
    """F36."""
    return voxels(spark, sf).select(*K.KEY, *[K.requantise(F.col(a), 51, 16).alias(f"r{a}") for a in K.AXES])


@query()
def segment_group_norm(spark: SparkSession, sf: str) -> DataFrame:
    """Group norm of embeddings, a batch per label."""
    e = table(spark, sf, "embeddings").select("vec_id", "label", F.transform("embedding", lambda v: v.cast("double")).alias("f"))
    return K.group_norm(e, "label", "f", 16, 4).withColumn("f", F.transform("f", lambda v: S.round_signed(v, 6)))


@query()
def image_similarity(spark: SparkSession, sf: str) -> DataFrame:
    """SSIM between two 16 x 16 images per line status."""
    pixels = table(spark, sf, "lineitem").groupBy("l_linestatus", (F.col("l_partkey") % 16).alias("px"), (F.col("l_suppkey") % 16).alias("py")).agg(F.avg(F.col("l_discount") * 10).alias("a"), F.avg(F.col("l_tax") * 12).alias("b"))
    return M.ssim(pixels, "a", "b", ["l_linestatus"]).withColumn("ssim", F.round("ssim", 8))


@query()
def surface_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The nearest triangle of boxes for points near them."""
    from lattica.plans.geometry_queries import _mesh

    v, f = _mesh(spark, sf)
    tris = G.gather(f, v)
    points = table(spark, sf, "events").select(F.col("event_id").alias("pid"), *[(F.col("event_id") % m / m).alias(f"p{a}") for a, m in (("x", 17), ("y", 19), ("z", 23))])
    return G.nearest_surface(points, tris, 0.25).withColumn("dist", F.round("dist", 9)).select("pid", "dist")
