"""Slanted tetrahedra, one per part: grid crossings, touched cells, boundary cells, and textured volumes, all against SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.operators import geometry as G
from lattica.operators import volumes
from lattica.plans.geometry_queries import _mesh
from lattica.plans.registry import ORACLES, query, table

GRID, VOXEL = 12, 1 / 12

_BASE = ((0.1103, 7, 0.05), (0.1307, 5, 0.06), (0.1709, 3, 0.07))  # no corner lies on a grid plane
_CORNERS = ((0.0, 0.0, 0.0), (0.41, 0.07, 0.13), (0.09, 0.37, 0.19), (0.05, 0.15, 0.43))
_FACES = ((0, 1, 2), (0, 3, 1), (0, 2, 3), (1, 3, 2))
_UV = ((0.1, 0.2), (0.9, 0.3), (0.4, 1.4), (-0.3, 0.8))


#: A triangle's corners in SQL, where `by` is a keyword; and its edges.
_ENDS = ("va", "vb", "vc")
_EDGES = (("va", "vb"), ("vb", "vc"), ("vc", "va"))


def _d(x: float) -> str:
    return f"{x!r}::double"


def _tetrahedra(spark: SparkSession, sf: str, faces=_FACES) -> DataFrame:
    """(mesh, fid, mat, ax ... cz, au ... cv)."""
    p = F.col("p_partkey")
    base = [F.lit(b) + (p % m) * s for b, m, s in _BASE]
    one = [
        F.struct(F.lit(i).alias("fid"), *[(base[k] + _CORNERS[v][k]).alias(f"{c}{a}") for c, v in zip("abc", f, strict=True) for k, a in enumerate("xyz")],
                 *[F.lit(_UV[v][k]).alias(f"{c}{a}") for c, v in zip("abc", f, strict=True) for k, a in enumerate("uv")])
        for i, f in enumerate(faces)
    ]
    rows = table(spark, sf, "part").select(p.alias("mesh"), F.explode(F.array(*one)).alias("f")).select("mesh", "f.*")
    return rows.withColumn("mat", ((F.col("mesh") + F.col("fid")) % 3).cast("int"))


def _tetrahedra_sql(faces=_FACES) -> str:
    base = [f"({_d(b)} + (p_partkey % {m}) * {_d(s)})" for b, m, s in _BASE]
    rows = []
    for i, f in enumerate(faces):
        places = [f"{base[k]} + {_d(_CORNERS[v][k])} as {c}{a}" for c, v in zip(_ENDS, f, strict=True) for k, a in enumerate("xyz")]
        uv = [f"{_d(_UV[v][k])} as {c}{a}" for c, v in zip(_ENDS, f, strict=True) for k, a in enumerate("uv")]
        rows.append(f"select p_partkey as mesh, {i} as fid, {', '.join(places + uv)}, ((p_partkey + {i}) % 3)::int as mat from part")
    return "t as (" + " union all ".join(rows) + ")"


def _crossings_sql(grid: int, voxel: float) -> str:
    """hits(mesh, fid, axis, i, j, k): every grid line against every triangle of t, with the crossing's cell along the line."""
    out = []
    for axis in range(3):
        w, u, v = ("xyz"[(axis + s) % 3] for s in range(3))
        edges = []
        for n, (p, q) in enumerate(_EDGES):
            du, dv = f"({q}{u} - {p}{u})", f"({q}{v} - {p}{v})"
            swap = f"({du} < 0 or ({du} = 0 and {dv} < 0))"
            edges.append(f"case when {swap} then {q}{u} else {p}{u} end as s{n}u, case when {swap} then {q}{v} else {p}{v} end as s{n}v, case when {swap} then -{du} else {du} end as d{n}u, "
                         f"case when {swap} then -{dv} else {dv} end as d{n}v, case when {swap} then -sign(nw) else sign(nw) end as o{n}")  # fmt: skip
        e = lambda c, p, q: f"({q}{c} - {p}{c})"
        normal = {c: f"({e(a, 'va', 'vb')} * {e(b, 'vb', 'vc')} - {e(b, 'va', 'vb')} * {e(a, 'vb', 'vc')})" for c, a, b in (("nw", u, v), ("nu", v, w), ("nv", w, u))}
        side = [f"o{n} * (d{n}u * (y - s{n}v) - d{n}v * (x - s{n}u))" for n in range(3)]
        inside = " and ".join(f"({s} > 0 or ({s} = 0 and (o{n} * d{n}v > 0 or (d{n}v = 0 and o{n} * d{n}u < 0))))" for n, s in enumerate(side))
        out.append(
            f"n{axis} as (select *, {', '.join(f'{q} as {c}' for c, q in normal.items())} from t), e{axis} as (select *, {', '.join(edges)} from n{axis} where nw <> 0), "
            f"l{axis} as (select e{axis}.*, g.i, h.j, g.i * {_d(voxel)} as x, h.j * {_d(voxel)} as y from e{axis}, range(1, {grid}) g(i), range(1, {grid}) h(j) "
            f"where g.i * {_d(voxel)} between least(va{u}, vb{u}, vc{u}) - 1e-9 and greatest(va{u}, vb{u}, vc{u}) + 1e-9 and h.j * {_d(voxel)} between least(va{v}, vb{v}, vc{v}) - 1e-9 and greatest(va{v}, vb{v}, vc{v}) + 1e-9), "
            f"h{axis} as (select mesh, fid, {axis} as axis, i, j, trunc((va{w} - (nu * (x - va{u}) + nv * (y - va{v})) / nw) / {_d(voxel)}) as k from l{axis} where {inside})"
        )
    around = []
    for axis in range(3):
        at = {(axis + 0) % 3: "k", (axis + 1) % 3: "i - 1 + di", (axis + 2) % 3: "j - 1 + dj"}
        around.append(f"select mesh, fid, axis, di + dj = 0 as own, {', '.join(f'({at[n]})::int as {a}' for n, a in enumerate('xyz'))} from h{axis}, range(2) di(di), range(2) dj(dj) where k >= 0 and k < {grid}")
    return ", ".join(out) + f", hits as ({' union all '.join(around)})"


@query(f"with {_tetrahedra_sql()}, {_crossings_sql(GRID, VOXEL)} select mesh, fid, axis::int as axis, own::int as own, x, y, z from hits")
def grid_crossings(spark: SparkSession, sf: str) -> DataFrame:
    """The cells around every grid edge that a triangle crosses."""
    hits = G.scan_convert(_tetrahedra(spark, sf), VOXEL, GRID)
    return hits.select("mesh", "fid", "axis", F.col("first").alias("own"), "x", "y", "z")


def _touched_sql() -> str:
    e = lambda c, p, q: f"({q}{c} - {p}{c})"
    normal = ", ".join(f"({e(a, 'va', 'vb')} * {e(b, 'vb', 'vc')} - {e(b, 'va', 'vb')} * {e(a, 'vb', 'vc')}) as n{c}" for c, a, b in (("x", "y", "z"), ("y", "z", "x"), ("z", "x", "y")))
    vx = _d(VOXEL)
    plane = lambda pick: " + ".join(f"n{c} * (i{c} + case when n{c} {pick} 0 then 1 else 0 end) * {vx}" for c in "xyz")
    sides = []
    for w, u, v in (("z", "x", "y"), ("x", "y", "z"), ("y", "z", "x")):
        sign = f"case when n{w} < 0 then -1 else 1 end"
        for p, q in _EDGES:
            mu, mv = f"(-{sign} * {e(v, p, q)})", f"({sign} * {e(u, p, q)})"
            sides.append(f"({mu} * (i{u} * {vx} - {p}{u}) + {mv} * (i{v} * {vx} - {p}{v}) + greatest({mu}, 0) * {vx} + greatest({mv}, 0) * {vx} >= 0)")
    span = lambda c: f"i{c} between trunc(least(va{c}, vb{c}, vc{c}) / {vx}) and trunc(greatest(va{c}, vb{c}, vc{c}) / {vx} + 1) - 1"
    cells = ", ".join(f"range({GRID}) r{c}(i{c})" for c in "xyz")
    return (
        f"n as (select *, {normal} from t), o as (select *, -(nx * vax + ny * vay + nz * vaz) as nd from n), c as (select * from o, {cells} where {span('x')} and {span('y')} and {span('z')}) "
        f"select mesh, fid, ix::int as x, iy::int as y, iz::int as z from c where ({plane('>')} + nd) * ({plane('<=')} + nd) <= 0 and {' and '.join(sides)}"
    )


@query(f"with {_tetrahedra_sql()}, {_touched_sql()}")
def touched_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The cells that every triangle touches."""
    return G.overlapping_cells(_tetrahedra(spark, sf), VOXEL, GRID)


_WAY = ", ".join(f"floor(va{c} / {_d(VOXEL)})::int as o{c}, vb{c} - va{c} as w{c}" for c in "xyz")
_STEPS = " union all ".join(
    f"select mesh, fid, 3 - {n} as ord, '{c}' as axis, case when w{c} > 0 then 1 else -1 end as step, (p * {_d(VOXEL)} - va{c}) / w{c} as s from w, range(0, {GRID + 1}) r(p) "
    f"where w{c} <> 0 and ((w{c} > 0 and p > o{c} and p <= floor(vb{c} / {_d(VOXEL)})) or (w{c} < 0 and p <= o{c} and p >= ceil(vb{c} / {_d(VOXEL)})))"
    for n, c in enumerate("xyz")
)


@query(f"""
with {_tetrahedra_sql()}, w as (select *, {_WAY} from t), s as ({_STEPS}),
m as (select mesh, fid, {', '.join(f"sum(case when axis = '{c}' then step else 0 end) over o as m{c}" for c in "xyz")} from s window o as (partition by mesh, fid order by s, ord rows unbounded preceding))
select mesh, fid, ox as x, oy as y, oz as z from w union all select mesh, fid, (ox + mx)::int, (oy + my)::int, (oz + mz)::int from m join w using (mesh, fid)
""")
def edge_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The cells along the first edge of every triangle."""
    rows = _tetrahedra(spark, sf).select("mesh", "fid", *[f"{c}{a}" for c in "ab" for a in "xyz"])
    return G.traverse(rows, VOXEL, GRID).select("mesh", "fid", "x", "y", "z")


_BOXES = (
    "c as (select p_partkey as mesh, i as vid, " + ", ".join(f"((p_partkey % {m} + 2.3::double) / 16) + (({'i' if k == 0 else f'(i >> {k})'}) & 1) * 4.2::double / 16 as {a}" for k, (a, m) in enumerate(zip("xyz", (5, 6, 7), strict=True)))
    + " from part, range(8) r(i)), t as (select f.mesh, f.fid, " + ", ".join(f"{c}.{a} as {c}{a}" for c in _ENDS for a in "xyz")
    + " from (select p_partkey as mesh, fid, v[1] as v0, v[2] as v1, v[3] as v2 from part, (select unnest(range(11)) as fid, unnest([[0, 2, 1], [1, 2, 3], [4, 5, 6], [5, 7, 6], [0, 1, 4], [1, 5, 4], [2, 6, 3], [3, 6, 7], [0, 4, 2], [2, 4, 6], [1, 3, 5]]) as v)) f"
    " join c va on va.mesh = f.mesh and va.vid = f.v0 join c vb on vb.mesh = f.mesh and vb.vid = f.v1 join c vc on vc.mesh = f.mesh and vc.vid = f.v2)"
)
_FLAGGED = f"with {_BOXES}, {_crossings_sql(16, 1 / 16)}, cells as (select mesh, x, y, z, coalesce(bit_or(case when own then 1 << axis end), 0)::int as flags, count(*)::bigint as cnt from hits group by all)"


@query(f"{_FLAGGED} select mesh, x, y, z, flags from cells")
def dual_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The cells and crossed edges of a dual grid of boxes."""
    return G.mesh_to_grid(*_mesh(spark, sf), 1 / 16, 16).select("mesh", "x", "y", "z", "flags")


_QUADS = (
    ((0, 0, 0), (0, 0, 1), (0, 1, 1), (0, 1, 0)),
    ((0, 0, 0), (1, 0, 0), (1, 0, 1), (0, 0, 1)),
    ((0, 0, 0), (0, 1, 0), (1, 1, 0), (1, 0, 0)),
)
GRID_TRIANGLES = (
    _FLAGGED + ", q as ("
    + " union all ".join(
        f"select c.mesh as b, {axis} as axis, [" + ", ".join(f"(((c.x + {o[0]}) * 16 + c.y + {o[1]}) * 16 + c.z + {o[2]})" for o in offsets) + "] as q from cells c "
        + " ".join(f"join cells n{k} on n{k}.mesh = c.mesh and n{k}.x = c.x + {o[0]} and n{k}.y = c.y + {o[1]} and n{k}.z = c.z + {o[2]}" for k, o in enumerate(offsets) if k)
        + f" where (c.flags >> {axis}) & 1 = 1"
        for axis, offsets in enumerate(_QUADS)
    )
    + "), w as (select *, (1 + q[1] % 3) * (1 + q[3] % 3) > (1 + q[2] % 3) * (1 + q[4] % 3) as first from q), s as (select b, axis, unnest([0, 1]) as t, unnest(case when first then [[q[1], q[2], q[3]], [q[1], q[3], q[4]]]"
    " else [[q[1], q[2], q[4]], [q[4], q[2], q[3]]] end) as v from w) select b, axis::int as axis, t::int as t, v[1]::int as v0, v[2]::int as v1, v[3]::int as v2 from s"
)


# --- textured volumes -----------------------------------------------------------------------------------------------

#: (texture, side, wrap mode, linear)
_TEXTURES = ((1, 16, 0, True), (2, 8, 2, True), (3, 4, 1, False))
#: mat, base factor, metallic, roughness, alpha mode, factor and cutoff, base, roughness and alpha texture
_MATERIALS = (
    (0, (0.5, 1.0, 0.25), 0.75, 1.0, "BLEND", 0.5, 0.5, 1, None, 2),
    (1, (1.0, 1.0, 1.0), 0.125, 0.5, "MASK", 1.0, 0.25, 2, 3, 1),
    (2, (0.25, 0.5, 1.0), 1.0, 0.25, "OPAQUE", 0.5, 0.5, None, 1, None),
)


def _texels(spark: SparkSession, sf: str) -> DataFrame:
    """The parts' retail prices, sizes and keys as the channels of three textures."""
    sides = spark.createDataFrame([(t, s) for t, s, _, _ in _TEXTURES], "tex int, size int")
    spine = sides.select("tex", "size", F.explode(F.sequence(F.lit(0), F.col("size") * F.col("size") - 1)).alias("i"))
    at = spine.select("tex", (F.col("i") % F.col("size")).cast("int").alias("tx"), F.floor(F.col("i") / F.col("size")).cast("int").alias("ty"), F.col("i"))
    p = table(spark, sf, "part").groupBy((F.col("p_partkey") % 256).alias("i")).agg(F.sum("p_size").alias("s"))
    c = F.coalesce("s", F.lit(0))
    return at.join(p, "i", "left").select("tex", "tx", "ty", (c * 7 % 256).alias("c0"), (c * 31 % 256).alias("c1"), ((c + F.col("i")) % 256).alias("c2"))


def _volume_tables(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    schema = "mat int, base_factor array<double>, metallic_factor double, roughness_factor double, alpha_mode string, alpha_factor double, alpha_cutoff double, base_tex int, roughness_tex int, alpha_tex int"
    none = F.lit(None).cast("int")
    materials = spark.createDataFrame([(m, list(b), *rest) for m, b, *rest in _MATERIALS], schema).withColumns({
        "emissive_factor": F.array(*[F.lit(0.0)] * 3), "metallic_tex": none, "emissive_tex": none, "normal_tex": none,
    })
    return materials, spark.createDataFrame([list(t) for t in _TEXTURES], "tex int, size int, wrap int, linear boolean")


def _sql_rows(rows, columns: str) -> str:
    def cell(x) -> str:
        if x is None:
            return "null"
        if isinstance(x, tuple):
            return "[" + ", ".join(map(cell, x)) + "]"
        return f"'{x}'" if isinstance(x, str) else str(x).lower() if isinstance(x, bool) else _d(x) if isinstance(x, float) else str(x)

    return f"(select * from (values {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)}) as _({columns}))"


def _dot(a: list[str], b: list[str]) -> str:
    return "(" + " + ".join(f"({p}) * ({q})" for p, q in zip(a, b, strict=True)) + ")"


def _volume_sql() -> str:
    e = lambda p, q: [f"({q}{c} - {p}{c})" for c in "xyz"]
    ab, ac, bc = e("va", "vb"), e("va", "vc"), e("vb", "vc")
    cross = [f"({ab[(k + 1) % 3]} * {bc[(k + 2) % 3]} - {ab[(k + 2) % 3]} * {bc[(k + 1) % 3]})" for k in range(3)]
    det = "((vbu - vau) * (vcv - vav) - (vbv - vav) * (vcu - vau))"
    tangent = [f"((vcv - vav) * {p} - (vbv - vav) * {q})" for p, q in zip(ab, ac, strict=True)]
    bitangent = [f"((vbu - vau) * {q} - (vcu - vau) * {p})" for p, q in zip(ab, ac, strict=True)]
    wrap = lambda i: f"case wrap when 1 then greatest(0, least({i}, side - 1)) when 2 then case when ((({i}) % (2 * side)) + 2 * side) % (2 * side) < side then ((({i}) % (2 * side)) + 2 * side) % (2 * side) else 2 * side - 1 - ((({i}) % (2 * side)) + 2 * side) % (2 * side) end else ((({i}) % side) + side) % side end"
    taps = ", ".join(f"{{'i': (x0 + {i})::int, 'j': (y0 + {j})::int, 'w': ({'wx' if i else '(1 - wx)'}) * ({'wy' if j else '(1 - wy)'})}}" for i in (0, 1) for j in (0, 1))
    mips = ", ".join(
        f"m{n} as (select tex, {n} as level, tx // 2 as tx, ty // 2 as ty, sum(c0) // 4 as c0, sum(c1) // 4 as c1, sum(c2) // 4 as c2 from {'texels' if n == 1 else f'm{n - 1}'} where tex in (select tex from textures where linear and size >= {1 << n}) group by all)"
        for n in range(1, 5)
    )
    return f"""
with {_tetrahedra_sql()}, {_crossings_sql(GRID, VOXEL)},
materials as {_sql_rows(_MATERIALS, "mat, base_factor, metallic_factor, roughness_factor, alpha_mode, alpha_factor, alpha_cutoff, base_tex, roughness_tex, alpha_tex")},
textures as {_sql_rows(_TEXTURES, "tex, size, wrap, linear")},
spine as (select tex, size, unnest(range(size * size)) as i from textures), sums as (select p_partkey % 256 as i, sum(p_size)::bigint as s from part group by 1),
texels as (select tex, i % size as tx, i // size as ty, coalesce(s, 0) * 7 % 256 as c0, coalesce(s, 0) * 31 % 256 as c1, (coalesce(s, 0) + i) % 256 as c2 from spine left join sums using (i)),
{mips},
pyramid as (select tex, 0 as level, tx, ty, c0, c1, c2 from texels union all from m1 union all from m2 union all from m3 union all from m4),
one as (select distinct mesh, fid, x, y, z from hits),
faces as (select *, sqrt({_dot(cross, cross)}) as len, {', '.join(f'{c} as r{a}' for c, a in zip(cross, 'xyz', strict=True))}, abs({det}) < 1e-6 as bad, {det} as det, sqrt({_dot(tangent, tangent)}) as tl, sqrt({_dot(bitangent, bitangent)}) as bl from t),
placed as (select o.x, o.y, o.z, f.*, {', '.join(f"(o.{a} + 0.5::double) * {_d(VOXEL)} as p{a}" for a in "xyz")}, r{'x'} / len as nx, ry / len as ny, rz / len as nz,
    {_d(VOXEL)} / sqrt((case when bad then 1e6 else tl / det end) * (case when bad then 1e6 else bl / det end)) as footprint from one o join faces f using (mesh, fid)),
away as (select *, (px - vax) * nx + (py - vay) * ny + (pz - vaz) * nz as d from placed),
flat as (select *, {', '.join(f"p{a} - d * n{a} - va{a} as q{a}" for a in "xyz")} from away),
dots as (select *, {_dot(ab, ab)} as d00, {_dot(ab, ac)} as d01, {_dot(ac, ac)} as d11, {_dot(['qx', 'qy', 'qz'], ab)} as d20, {_dot(['qx', 'qy', 'qz'], ac)} as d21 from flat),
bary as (select *, (d11 * d20 - d01 * d21) / (d00 * d11 - d01 * d01) as b1, (d00 * d21 - d01 * d20) / (d00 * d11 - d01 * d01) as b2 from dots),
cells as (select *, (1 - b1 - b2) * vau + b1 * vbu + b2 * vcu as u, (1 - b1 - b2) * vav + b1 * vbv + b2 * vcv as v, 1 - d as weight from bary join materials using (mat)),
asked as (select mesh, fid, x, y, z, u, v, footprint, s.slot, s.tex from (select *, unnest([{{'slot': 'base', 'tex': base_tex}}, {{'slot': 'roughness', 'tex': roughness_tex}}, {{'slot': 'alpha', 'tex': alpha_tex}}]) as s from cells) where s.tex is not null),
levelled as (select a.*, size, wrap, linear, log2(footprint * size) as l, log2(size)::int as last from asked a join textures using (tex)),
reads as (select *, unnest(case when not linear or l <= 0 then [{{'at': 0, 'w': 1::double}}] when l >= last then [{{'at': last, 'w': 1::double}}] else [{{'at': floor(l)::int, 'w': 1 - (l - floor(l))}}, {{'at': floor(l)::int + 1, 'w': l - floor(l)}}] end) as r from levelled),
sided as (select *, r.at as level, r.w as lw, (size >> r.at) as side from reads),
spots as (select *, u * side as sx, (1 - v) * side as sy from sided),
corners as (select *, floor(sx - 0.5) as x0, floor(sy - 0.5) as y0, sx - floor(sx - 0.5) - 0.5 as wx, sy - floor(sy - 0.5) - 0.5 as wy from spots),
tapped as (select *, unnest(case when linear then [{taps}] else [{{'i': floor(sx)::int, 'j': floor(sy)::int, 'w': 1::double}}] end) as tap from corners),
wrapped as (select mesh, fid, x, y, z, slot, tex, level, {wrap('tap.i')} as tx, {wrap('tap.j')} as ty, lw * tap.w as w from tapped),
sampled as (select mesh, fid, x, y, z, slot, sum(w * c0) / 255 as c0, sum(w * c1) / 255 as c1, sum(w * c2) / 255 as c2 from wrapped join pyramid using (tex, level, tx, ty) group by all),
valued as (select c.*, {', '.join(f"coalesce(b.c{i}, 1) * base_factor[{i + 1}] as base{i}" for i in range(3))}, coalesce(r.c0, 1) * roughness_factor as rough,
    case alpha_mode when 'OPAQUE' then 1 when 'MASK' then case when coalesce(a.c0, 1) * alpha_factor >= alpha_cutoff then 1 else 0 end else coalesce(a.c0, 1) * alpha_factor end as alpha
    from cells c left join sampled b on b.slot = 'base' and (b.mesh, b.fid, b.x, b.y, b.z) = (c.mesh, c.fid, c.x, c.y, c.z) left join sampled r on r.slot = 'roughness' and (r.mesh, r.fid, r.x, r.y, r.z) = (c.mesh, c.fid, c.x, c.y, c.z)
    left join sampled a on a.slot = 'alpha' and (a.mesh, a.fid, a.x, a.y, a.z) = (c.mesh, c.fid, c.x, c.y, c.z))
select mesh, x, y, z, {', '.join(f"round(sum(weight * base{i}) / sum(weight), 6) as base_{c}" for i, c in enumerate("rgb"))}, round(sum(weight * metallic_factor) / sum(weight), 6) as metallic,
    round(sum(weight * rough) / sum(weight), 6) as roughness, round(sum(weight * alpha) / sum(weight), 6) as alpha, {', '.join(f"round(sum(weight * n{a}) / sum(weight), 6) as normal_{a}" for a in "xyz")}
from valued group by mesh, x, y, z"""


@query(_volume_sql())
def textured_volume(spark: SparkSession, sf: str) -> DataFrame:
    """J17, F29, A14 and the parts they join: textured tetrahedra as cells with material attributes."""
    materials, textures = _volume_tables(spark)
    out = volumes.volumetric_attributes(_tetrahedra(spark, sf), materials, textures, _texels(spark, sf), VOXEL, GRID)
    shown = ["base_r", "base_g", "base_b", "metallic", "roughness", "alpha", "normal_x", "normal_y", "normal_z"]
    return out.select("mesh", "x", "y", "z", *[F.round(c, 6).alias(c) for c in shown])


ORACLES["grid_to_triangles"] = GRID_TRIANGLES  # of a query that stands beside the other geometry


def _nearest_sql() -> str:
    """Every place against every triangle: the projection where it falls inside, else the nearest edge."""
    sub = lambda p, q: [f"({q}{c} - {p}{c})" for c in "xyz"]
    square = lambda v: _dot(v, v)
    ab, ac, ap = sub("va", "vb"), sub("va", "vc"), sub("va", "p")
    edges = []
    for n, (p, q) in enumerate(_EDGES):
        way, off = sub(p, q), sub(p, "p")
        t = f"greatest(0, least(1, coalesce({_dot(off, way)} / nullif({square(way)}, 0), 0)))"
        edges.append(f"{t} as t{n}")
    ends = [square([f"({o} - t{n} * {w})" for o, w in zip(sub(p, "p"), sub(p, q), strict=True)]) for n, (p, q) in enumerate(_EDGES)]
    flat = square([f"({o} - v * {x} - w * {y})" for o, x, y in zip(ap, ab, ac, strict=True)])
    return f"""
with {_BOXES}, tris as (select distinct {', '.join(f'{c}{a}' for c in _ENDS for a in 'xyz')} from t),
e as (select event_id as pid, event_id % 17 / 17.0::double as px, event_id % 19 / 19.0::double as py, event_id % 23 / 23.0::double as pz from events),
places as (select distinct px, py, pz from e),
d as (select *, {square(ab)} as d00, {_dot(ab, ac)} as d01, {square(ac)} as d11, {_dot(ap, ab)} as d20, {_dot(ap, ac)} as d21, {', '.join(edges)} from places, tris),
b as (select *, (d11 * d20 - d01 * d21) / nullif(d00 * d11 - d01 * d01, 0) as v, (d00 * d21 - d01 * d20) / nullif(d00 * d11 - d01 * d01, 0) as w from d),
n as (select px, py, pz, min(least(case when v >= 0 and w >= 0 and v + w <= 1 then {flat} else 1e300 end, {', '.join(ends)})) as q from b group by 1, 2, 3)
select pid, round(sqrt(q), 9) as dist from e join n using (px, py, pz)"""


ORACLES["surface_lookup"] = _nearest_sql()
