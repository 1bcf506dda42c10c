"""Queries of data sets, patches and cube maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.operators import catalog as C
from lattica.operators import coords as K
from lattica.operators import geometry as G
from lattica.operators.datasets import Dataset, image_conditioned, replace_failed
from lattica.plans.registry import query, table
from lattica.plans.spatial_queries import KEY, VOXELS, voxels

_SOURCES = """
s as (select 'orders' as root, o_orderkey as id, o_orderkey % 50 as score, case when o_orderkey % 5 <> 0 then true end as cond_rendered from orders
    union all select 'parts', p_partkey, p_size::bigint, null from part)
"""


def _sources(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Orders with rendered conditions for four of five; parts, whose catalog has no such column."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 50).alias("score"), F.when(F.col("o_orderkey") % 5 != 0, True).alias("cond_rendered"))
    return {"orders": orders, "parts": table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").cast("long").alias("score"))}


def _data() -> Dataset:
    return Dataset("id").where("Score", lambda df: C.at_most("score", 40)).where("Odd", lambda df: F.col("score") % 2 == 1)


@query(f"""
with {_SOURCES}, c as (select root, count(*) as a, count(*) filter (score <= 40) as b, count(*) filter (score <= 40 and score % 2 = 1) as c, count(*) filter (score <= 40 and score % 2 = 1 and cond_rendered is not null) as d from s group by 1)
select root, 0 as step, 'total' as name, a as survivors from c union all select root, 1, 'Score', b from c union all select root, 2, 'Odd', c from c union all select root, 3, 'Cond rendered', d from c
""")
def dataset_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Rows left after each predicate of a data set and its mixin, per source."""
    return image_conditioned(_data(), 12).stats(_sources(spark, sf))


@query(f"""
with {_SOURCES}, i as (select *, (('0x' || md5('0:k:' || id::varchar)[:8])::bigint % 4) + 1 as k from s where score <= 40 and score % 2 = 1 and cond_rendered is not null),
v as (select root, id, score, k, view::int as view, row_number() over (partition by root, id order by ('0x' || md5('0:' || view::varchar || ':' || id::varchar)[:8])::bigint, view) as r from i, unnest(range(0, 12)) as t(view))
select root, id, score, view from v where r <= k
""")
def dataset_views(spark: SparkSession, sf: str) -> DataFrame:
    """Instances with up to four views each."""
    return image_conditioned(_data(), 12, 4).instances(_sources(spark, sf)).select("root", "id", "score", "view")


def _load(row: dict) -> dict:
    if row["id"] % 7 == 0:
        raise ValueError("unreadable")
    return {"doubled": row["score"] * 2}


@query(f"""
with {_SOURCES}, i as (select * from s where score <= 40 and score % 2 = 1), g as (select root, id, score * 2 as doubled, row_number() over (order by root, id) - 1 as i, count(*) over () as n from i where id % 7 <> 0),
b as (select root, id, ('0x' || md5('0:' || root || ':' || id::varchar)[:8])::bigint % (select max(n) from g) as i from i where id % 7 = 0)
select root, id, doubled, root as from_root, id as from_key from g union all select b.root, b.id, g.doubled, g.root, g.id from b join g using (i)
""")
def dataset_loaded(spark: SparkSession, sf: str) -> DataFrame:
    """Loaded instances; a place whose instance can't be read takes another's."""
    return replace_failed(_data().load(_sources(spark, sf), _load, "doubled long"), "id")


_DENSE = """r as (select b::int as b, x::int as x, y::int as y, z::int as z from range(2) i(b), range(52) j(x), range(12) k(y), range(10) l(z)),
g as (select b, x, y, z, coalesce(n, 0)::double as n, (x + y)::double as t from r left join v using (b, x, y, z))"""
_BLOCK = "(x % 2) * 4 + (y % 2) * 2 + z % 2"


def _dense(spark: SparkSession, sf: str) -> DataFrame:
    rows = K.densify(voxels(spark, sf), 2, (52, 12, 10), "n")
    return rows.select(*KEY, F.array(F.col("n").cast("double"), (F.col("x") + F.col("y")).cast("double")).alias("feats"))


@query(f"with {VOXELS}, {_DENSE} select b, x // 2 as x, y // 2 as y, z // 2 as z, list_concat(list(n order by {_BLOCK}), list(t order by {_BLOCK})) as feats from g group by 1, 2, 3, 4")
def patches(spark: SparkSession, sf: str) -> DataFrame:
    """blocks of a dense grid as cells with all their channels."""
    return K.patchify(_dense(spark, sf), 2)


@query(f"with {VOXELS}, {_DENSE} select b, x, y, z, [n, t] as feats from g")
def unpatched(spark: SparkSession, sf: str) -> DataFrame:
    """patches taken apart are the grid again."""
    return K.unpatchify(K.patchify(_dense(spark, sf), 2), 2)


@query("""
select vec_id as b, (label * 2 + s // 4)::int as x, (s // 2 % 2)::int as y, (2 + s % 2)::int as z, list_transform(range(len(embedding) // 8), lambda c: embedding[c * 8 + s + 1]) as feats
from embeddings, range(8) t(s)
""")
def pixel_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    """channels spread over finer cells."""
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("b"), F.col("label").cast("int").alias("x"), F.lit(0).alias("y"), F.lit(1).alias("z"), F.col("embedding").alias("feats"))
    return K.pixel_shuffle(rows, 2)


def _face_sql() -> str:
    term = lambda t: f"({t[0]} + ({t[1]}) * x + ({t[2]}) * y)"
    return " union all ".join(f"select {f} as face, px, py, {', '.join(f'{term(t)} as {a}' for t, a in zip(axes, ('dx', 'dy', 'dz'), strict=True))} from p" for f, axes in enumerate(G.CUBE_FACES))


@query(f"""
with t as (select p_partkey % 16 as tx, p_partkey // 16 % 8 as ty, avg(p_size * 5) as value from part group by 1, 2),
p as (select px, py, (px * 2 + 1) / 8.0::double - 1 as x, (py * 2 + 1) / 8.0::double - 1 as y from range(8) a(px), range(8) b(py)), d as ({_face_sql()}),
e as (select *, sqrt(dx * dx + dy * dy + dz * dz) as l from d), u as (select face, px, py, (atan2(dx, -dz) / (2 * pi()) + 0.5) * 16 - 0.5 as u, acos(greatest(-1, least(1, dy / l))) / pi() * 8 - 0.5 as v from e),
c as (select face, px, py, (floor(u)::int + i + 16) % 16 as tx, (floor(v)::int + j + 8) % 8 as ty, (case when i = 1 then u - floor(u) else 1 - (u - floor(u)) end) * (case when j = 1 then v - floor(v) else 1 - (v - floor(v)) end) as w
    from u, unnest([0, 1]) a(i), unnest([0, 1]) b(j))
select face::int as face, px::int as px, py::int as py, round(sum(w * value) / 255, 6) as value from c join t using (tx, ty) group by 1, 2, 3
""")
def cube_maps(spark: SparkSession, sf: str) -> DataFrame:
    """the faces of a cube map from a panorama."""
    key = F.col("p_partkey")
    texels = table(spark, sf, "part").groupBy((key % 16).cast("int").alias("tx"), F.pmod(F.floor(key / 16), F.lit(8)).cast("int").alias("ty")).agg(F.avg(F.col("p_size") * 5).alias("value"))
    return G.cube_map(texels, 16, 8, 8).withColumn("value", F.round("value", 6))
