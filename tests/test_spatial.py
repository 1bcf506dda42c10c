from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lattica.functions import curves
from lattica.functions import scalars as S
from lattica.operators import codecs
from lattica.operators import coords as K
from lattica.operators import geometry as G
from lattica.sources import voxel_files as V

POINTS = [(0, 0, 0), (1023, 1023, 1023), (1023, 0, 1), (0, 1023, 512), (255, 256, 257), (1, 2, 4), (7, 7, 7)]


def table(spark, rows, schema="b int, x int, y int, z int, p long"):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("axes", [(0, 1, 2), (2, 0, 1), (1, 2, 0)])
def test_z_order_round_trip(spark, axes):
    df = spark.createDataFrame(POINTS, "x int, y int, z int").withColumn("c", curves.z_order("x", "y", "z", axes))
    for r in df.withColumn("d", curves.z_order_decode("c", axes)).collect():
        assert tuple(r.d) == (r.x, r.y, r.z)
        want = sum(((([r.x, r.y, r.z][a]) >> i) & 1) << (3 * i + s) for i in range(10) for a, s in zip(axes, (2, 1, 0), strict=True))
        assert r.c == want


def test_hilbert_is_a_continuous_bijection(spark):
    n = 8
    df = spark.createDataFrame([(x, y, z) for x in range(n) for y in range(n) for z in range(n)], "x int, y int, z int")
    rows = df.withColumn("c", curves.hilbert("x", "y", "z")).withColumn("d", curves.hilbert_decode("c")).orderBy("c").collect()
    assert all(tuple(r.d) == (r.x, r.y, r.z) for r in rows)
    assert [r.c for r in rows] == list(range(n**3))
    assert all(abs(a.x - b.x) + abs(a.y - b.y) + abs(a.z - b.z) == 1 for a, b in zip(rows, rows[1:], strict=False))
    far = spark.createDataFrame(POINTS, "x int, y int, z int").withColumn("d", curves.hilbert_decode(curves.hilbert("x", "y", "z")))
    assert all(tuple(r.d) == (r.x, r.y, r.z) for r in far.collect())


def test_covering_ranges_cover(spark):
    low, high = (3, 5, 2), (9, 6, 12)
    df = spark.createDataFrame([(x, y, z) for x in range(16) for y in range(16) for z in range(16)], "x int, y int, z int")
    got = df.where(curves.in_box(curves.z_order("x", "y", "z"), low, high, 1))
    inside = F.col("x").between(3, 9) & F.col("y").between(5, 6) & F.col("z").between(2, 12)
    assert got.where(inside).count() == df.where(inside).count()


def test_pool_and_expand(spark):
    v = table(spark, [(0, 0, 0, 0, 1), (0, 1, 1, 1, 3), (0, 2, 0, 0, 5), (1, -1, -2, 0, 7)])
    mean = {(r.b, r.x, r.y, r.z): r.p for r in K.pool(v, 2, ["p"]).collect()}
    assert mean == {(0, 0, 0, 0): 2.0, (0, 1, 0, 0): 5.0, (1, -1, -1, 0): 7.0}
    back = K.expand(K.pool(v, 2, ["p"]).join(K.subdivision(v), list(K.KEY)), 2, ["p"])
    assert K.same_cells(back, v)
    full = table(spark, [(0, x, y, z, 1) for x in (0, 1) for y in (0, 1) for z in (0, 1)])
    assert K.subdivision(full).first().mask == 255


def test_array_pool_and_channels(spark):
    v = spark.createDataFrame([(0, 0, 0, 0, [1.0, 2.0]), (0, 1, 0, 0, [3.0, 6.0])], "b int, x int, y int, z int, feats array<double>")
    assert K.pool_array(v, 2).first().feats == [2.0, 4.0]
    wide = K.space_to_channel(v, width=2)
    assert wide.first().feats == [1.0, 2.0, 3.0, 6.0] + [0.0] * 12
    assert sorted(r.feats for r in K.channel_to_space(wide, width=2).collect()) == [[1.0, 2.0], [3.0, 6.0]]
    r = v.select(K.fold_channels(F.col("feats"), 1, 2).alias("f"), K.repeat_channels(F.col("feats"), 2).alias("r"), K.denormalise(K.normalise(F.col("feats"), [1, 2], [2, 4]), [1, 2], [2, 4]).alias("d")).first()
    assert (r.f, r.r, r.d) == ([1.5], [1.0, 1.0, 2.0, 2.0], [1.0, 2.0])


def test_convolution_at_existing_cells_only(spark):
    v = table(spark, [(0, 5, 5, 5, 2), (0, 6, 5, 5, 3)])
    got = {r.x: r.p for r in K.submanifold_conv(v, "p", [1] * 27).collect()}
    assert got == {5: 5, 6: 5}


def test_quads(spark):
    four = [(0, 0, 0, 0, 0), (0, 0, 0, 1, 1), (0, 0, 1, 1, 2), (0, 0, 1, 0, 3)]
    assert [r.quad for r in K.complete_quads(table(spark, four), "p", 0).collect()] == [[0, 1, 2, 3]]
    assert K.complete_quads(table(spark, four[:3]), "p", 0).count() == 0
    assert K.complete_quads(table(spark, four), "p", 1).count() == 0


def test_attention(spark):
    v = spark.createDataFrame([(0, 1, [1.0, 0.0]), (0, 2, [0.0, 1.0]), (1, 3, [2.0, 2.0])], "w int, i int, f array<double>")
    got = {r.i: r.out for r in K.attention(v, "w", "f", "f", "f", ["i"]).collect()}
    e = np.exp(1 / np.sqrt(2))
    assert np.allclose(got[1], [e / (e + 1), 1 / (e + 1)]) and got[3] == [2.0, 2.0]
    cross = K.cross_attention(v, v.where("w = 0"), "w", "f", "f", "f", ["i"])
    assert {r.i for r in cross.collect()} == {1, 2}


def test_group_norm(spark):
    v = spark.createDataFrame([(0, [1.0, 2.0, 5.0, 5.0]), (0, [3.0, 4.0, 5.0, 5.0])], "b int, feats array<double>")
    rows = [r.feats for r in K.group_norm(v, "b", "feats", 2, 2, eps=0.0 + 1e-12).collect()]
    assert np.allclose(sorted(x[0] for x in rows), [-1.3416407, 0.4472136], atol=1e-4)


codes = st.lists(st.integers(0, 8**4 - 1), min_size=1, max_size=120, unique=True).map(sorted)


@settings(max_examples=60, deadline=None)
@given(codes, st.integers(1, 3), st.integers(0, 2**32 - 1))
def test_codecs_round_trip(leaves, channels, seed):
    leaf = np.array(leaves, np.int64)
    attr = np.random.default_rng(seed).integers(0, 256, (len(leaf), channels)).astype(np.uint8)
    assert np.array_equal(codecs.decode_octree(codecs.encode_octree(leaf, 4), 4), leaf)
    assert np.array_equal(codecs.parent_unfilter(leaf, codecs.parent_filter(leaf, attr, 4), 4), attr)
    place = codecs.unmorton(leaf)
    assert np.array_equal(codecs.morton(place), leaf)
    assert np.array_equal(codecs.neighbour_unfilter(place, codecs.neighbour_filter(place, attr)), attr)


def test_parent_filter_by_hand():
    """Leaves 0, 1 and 9 at depth 2: the root keeps 10, then 50 - 10 for node 1, then 30 - 10 for leaf 1."""
    out = codecs.parent_filter(np.array([0, 1, 9]), np.array([[10], [30], [50]], np.uint8), 2)
    assert out.ravel().tolist() == [10, 40, 20]
    assert codecs.encode_octree(np.array([0, 1, 9]), 2) == bytes([0b11, 0b11, 0b10])


@pytest.mark.parametrize("how", ["none", "deflate", "lzma", "zstd"])
def test_compression(how):
    data = b"abc" * 100
    assert codecs.decompress(codecs.compress(data, how), how) == data
    with pytest.raises(ValueError, match="unknown"):
        codecs.compress(data, "zip9")


def test_relational_octree_is_the_byte_stream(spark):
    leaves = [0, 1, 9, 63, 100, 511]
    masks = codecs.octree_masks(spark.createDataFrame([(c,) for c in leaves], "code long"), 3).withColumn("t", F.lit(0))
    assert bytes(codecs.octree_bytes(masks, 3, ["t"]).first().svo) == codecs.encode_octree(np.array(leaves), 3)
    assert sorted(r.code for r in codecs.octree_leaves(masks, 3).collect()) == leaves
    values = spark.createDataFrame([(c, c * 7 % 256) for c in leaves], "code long, v int")
    delta = codecs.sibling_delta(values, 3, "v").where("level = 3")
    assert sorted(r.value for r in codecs.sibling_undelta(delta.drop("value")).collect()) == sorted(c * 7 % 256 for c in leaves)


def voxels(spark):
    rng = np.random.default_rng(5)
    cells = sorted({tuple(map(int, c)) for c in rng.integers(0, 40, (300, 3))} | {(255, 0, 0), (256, 0, 0)})
    rows = [("m", *c, [int(v) for v in rng.integers(0, 256, 3)], [int(rng.integers(0, 256))]) for c in cells]
    return spark.createDataFrame(rows, "asset string, x int, y int, z int, colour array<smallint>, rough array<smallint>")


LAYOUT = [("colour", 3), ("rough", 1)]


@pytest.mark.parametrize(("filter", "interleave", "compression"), [("none", "as_is", "lzma"), ("parent", "none", "deflate"), ("neighbor", "all", "zstd"), ("none", "all", "none")])
def test_vxz_round_trip(spark, tmp_path, filter, interleave, compression):
    v = voxels(spark)
    path = V.write_vxz(v, str(tmp_path), LAYOUT, chunk_size=64, filter=filter, compression=compression, interleave=interleave).first().path
    got = V.read_voxels(spark, path, ["colour", "rough"])
    key = lambda r: (r.x, r.y, r.z, list(r.colour), list(r.rough))
    assert sorted(map(key, got.collect())) == sorted(map(key, v.collect()))
    info = spark.read.format("vxz").option("mode", "info").load(path).first()
    assert (info.num_voxel, info.chunk_size, info.filter) == (v.count(), 64, filter)


def test_vxz_skips_chunks(spark, tmp_path):
    path = V.write_vxz(voxels(spark), str(tmp_path), LAYOUT, chunk_size=64).first().path
    far = V.read_voxels(spark, path, ["colour"]).where("x >= 200")
    assert far.rdd.getNumPartitions() == 2
    assert sorted(r.x for r in far.collect()) == [255, 256]


@pytest.mark.parametrize("kind", ["npz", "ply"])
def test_other_voxel_files(spark, tmp_path, kind):
    v = voxels(spark)
    path = V.write_voxels(v, str(tmp_path), kind, LAYOUT).first().path
    got = V.read_voxels(spark, path, ["colour", "rough"])
    key = lambda r: (r.x, r.y, r.z, list(r.colour), list(r.rough))
    assert sorted(map(key, got.collect())) == sorted(map(key, v.collect()))
    with pytest.raises(ValueError, match="unknown voxel file"):
        V.read_voxels(spark, "x.abc")


@pytest.mark.parametrize("binary", [True, False])
def test_mesh_ply(spark, tmp_path, binary):
    df = spark.createDataFrame([("m", [[0.0, 0.0, 0.5], [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [1.0, 1.0, 0.0]], [[0, 1, 2]], [[0, 1, 3, 2]])], "asset string, vertices array<array<double>>, tris array<array<int>>, quads array<array<int>>")
    V.write_mesh_ply(df, str(tmp_path), binary=binary).collect()
    r = V.read_meshes(spark, str(tmp_path)).first()
    assert (r.vertices[0], r.tris, r.quads) == ([0.0, 0.0, 0.5], [[0, 1, 2]], [[0, 1, 3, 2]])


def test_mesh_sequences(spark, tmp_path):
    np.savez(tmp_path / "o.npz", vertices=np.arange(18).reshape(2, 3, 3).astype(np.float16), faces=np.array([[0, 1, 2]]))
    v, f = V.read_mesh_sequences(spark, str(tmp_path))
    assert v.count() == 6 and f.count() == 1
    assert v.where("frame = 1 and vid = 2").first().z == 17.0


def test_boundary_edges(spark):
    one = spark.createDataFrame([(0, 0, 0, 1, 2)], "mesh int, fid int, v0 int, v1 int, v2 int")
    two = spark.createDataFrame([(0, 0, 0, 1, 2), (0, 1, 2, 1, 3)], "mesh int, fid int, v0 int, v1 int, v2 int")
    assert G.boundary_edges(one).count() == 3
    assert G.boundary_edges(two).count() == 4
    assert G.edge_counts(two).where("n = 2").collect()[0][1:3] == (1, 2)


def rows_of(blocks):
    return [tuple(r) for block in blocks for r in zip(*[c.tolist() for c in block], strict=True)]


def test_scan_conversion_of_one_triangle():
    """The triangle z = 0.5 over a 4 x 4 grid: grid lines along z at its inner corners cross it, those along x and y don't."""
    t = np.array([[[0.2, 0.2, 0.5], [3.7, 0.2, 0.5], [0.2, 3.7, 0.5]]])
    hits = rows_of(G._cells_around(t, 1.0, 4))
    assert {h[1] for h in hits} == {2}
    assert {h[3:6] for h in hits if h[2]} == {(0, 0, 0), (1, 0, 0), (0, 1, 0)}
    assert len(hits) == 12 and all(h[8] == 0.5 for h in hits)


def test_traversal_and_overlap():
    way = lambda a, b: [r[1:] for r in rows_of(G._passed(np.array([[a, b]], float), 1.0, 4))]
    assert way((0.5, 0.5, 0.5), (2.5, 0.5, 0.5)) == [(0, 0, 0), (1, 0, 0), (2, 0, 0)]
    assert way((2.5, 0.5, 0.5), (0.5, 0.5, 0.5)) == [(2, 0, 0), (1, 0, 0), (0, 0, 0)]
    assert way((0, 0, 0), (0, 0, 0)) == [] and way((0, 0, 0), (1, 1, 1)) == [(0, 0, 0), (0, 0, 1), (0, 1, 1), (1, 1, 1)]
    t = np.array([[[0.5, 0.5, 0.5], [1.5, 0.5, 0.5], [0.5, 1.5, 0.5]]])
    assert {r[1:] for r in rows_of(G._overlaps(t, 1.0, 4))} == {(0, 0, 0), (1, 0, 0), (0, 1, 0), (1, 1, 0)}


def test_range_joins_are_brute_force(monkeypatch):
    """Every grid line and every cell of the box tried for each triangle, every short step along each segment."""
    monkeypatch.setattr(G, "PAIRS", 37)
    rng = np.random.default_rng(8)
    grid, t = 7, rng.random((25, 3, 3)) * 7
    crossed, touched, passed = set(), set(), set()
    for o, (a, b, c) in enumerate(t):
        n = np.cross(b - a, c - a)
        for axis in range(3):
            u, v = (axis + 1) % 3, (axis + 2) % 3
            for i in range(1, grid):
                for j in range(1, grid):
                    s = np.linalg.solve([[b[u] - a[u], c[u] - a[u]], [b[v] - a[v], c[v] - a[v]]], [i - a[u], j - a[v]])
                    at = a[axis] + s @ [b[axis] - a[axis], c[axis] - a[axis]]
                    if min(s) >= 0 and sum(s) <= 1 and 0 <= at < grid:
                        crossed.add((o, axis, i - 1, j - 1, int(at)))
        for cell in np.ndindex(grid, grid, grid):
            corner = np.array(list(np.ndindex(2, 2, 2))) + cell
            side = (corner - a) @ n
            good = side.min() <= 0 <= side.max()
            for third in range(3):
                u, v = (third + 1) % 3, (third + 2) % 3
                for p, q in ((a, b), (b, c), (c, a)):
                    turn = (q[u] - p[u]) * (corner[:, v] - p[v]) - (q[v] - p[v]) * (corner[:, u] - p[u])
                    good &= (turn * (1 if n[third] >= 0 else -1)).max() >= 0
            low, high = np.minimum(a, np.minimum(b, c)), np.maximum(a, np.maximum(b, c))
            if good and all(int(low[k]) <= cell[k] < int(high[k] + 1) for k in range(3)):
                touched.add((o, *cell))
        passed |= {(o, *np.floor(a + (b - a) * k / 20000).astype(int).tolist()) for k in range(20001)}
    got = rows_of(G._cells_around(t, 1.0, grid))
    assert {(h[0], h[1], h[3 + (h[1] + 1) % 3], h[3 + (h[1] + 2) % 3], h[3 + h[1]]) for h in got if h[2]} == crossed and len(got) == 4 * len(crossed)
    found = rows_of(G._overlaps(t, 1.0, grid))
    assert set(found) == touched and len(found) == len(touched)
    steps = rows_of(G._passed(t[:, :2], 1.0, grid))
    assert passed <= set(steps) and len(set(steps) - passed) <= 2  # a step of 1/20000 may jump a corner
    assert all(sum(abs(p - q) for p, q in zip(a[1:], b[1:], strict=True)) == 1 for a, b in zip(steps, steps[1:], strict=False) if a[0] == b[0])


def test_a_grid_line_on_a_shared_edge_crosses_once():
    square = np.array([[[0, 0, 1.5], [4, 0, 1.5], [4, 4, 1.5]], [[0, 0, 1.5], [4, 4, 1.5], [0, 4, 1.5]]])
    for t in (square, square[:, ::-1], square[::-1, [1, 2, 0]]):
        lines = [(h[3], h[4]) for h in rows_of(G._cells_around(t, 1.0, 4)) if h[1] == 2 and h[2]]
        assert sorted(lines) == sorted(np.ndindex(3, 3))


def test_a_large_triangle_needs_little_memory():
    import tracemalloc

    t, grid = np.array([[[0.02, 0.03, 0.01], [0.97, 0.4, 0.9], [0.3, 0.95, 0.99]]]), 1024
    tracemalloc.start()
    cells = sum(len(block[0]) for block in G._overlaps(t, 1 / grid, grid))
    hits = sum(len(block[0]) for block in G._cells_around(t, 1 / grid, grid))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert cells > 5e5 and hits > 2e6 and peak < 2e8


def test_solve_in_box():
    planes = [(1, 0, 0, -0.25), (0, 1, 0, -0.5), (0, 0, 1, -3.0)]
    q = sum(np.outer(p, p) for p in planes)[None]
    low, high = np.zeros((1, 3)), np.ones((1, 3))
    assert np.allclose(G.solve_in_box(q, low, high), [[0.25, 0.5, 1.0]], atol=1e-6)
    inside = sum(np.outer(p, p) for p in [*planes[:2], (0, 0, 1, -0.75)])[None]
    assert np.allclose(G.solve_in_box(inside, low, high), [[0.25, 0.5, 0.75]], atol=1e-6)


def test_dual_grid_of_a_box_lies_on_its_faces(spark):
    from lattica.plans.geometry_queries import _mesh

    v, f = _mesh(spark, "/root/testdata/sf0.001")
    v, f = v.where("mesh = 1"), f.where("mesh = 1")
    cells = G.mesh_to_grid(v, f, 1 / 16, 16)
    low = {a: v.agg(F.min(a)).first()[0] for a in "xyz"}
    high = {a: v.agg(F.max(a)).first()[0] for a in "xyz"}
    rows = cells.collect()
    assert len(rows) > 50
    for r in rows:
        p = {"x": r.vx, "y": r.vy, "z": r.vz}
        assert min(min(abs(p[a] - low[a]), abs(p[a] - high[a])) for a in "xyz") < 0.02
        assert all(r[a] / 16 - 1e-9 <= p[a] <= (r[a] + 1) / 16 + 1e-9 for a in "xyz")


def test_quad_splits(spark):
    q = spark.createDataFrame([(1, [10, 11, 12, 13], [2.0, 1.0, 2.0, 1.0]), (2, [10, 11, 12, 13], [1.0, 2.0, 1.0, 2.0])], "i int, quad array<int>, weights array<double>")
    got = sorted((r.i, r.t, r.v0, r.v1, r.v2) for r in G.split_by_weight(q).collect())
    assert got == [(1, 0, 10, 11, 12), (1, 1, 10, 12, 13), (2, 0, 10, 11, 13), (2, 1, 13, 11, 12)]


def test_texture_rules(spark):
    df = spark.range(-9, 10).select(F.col("id").cast("int").alias("i"))
    got = {r.i: (r.a, r.b, r.c) for r in df.select("i", *[G.wrap(F.col("i"), 4, m).alias(n) for n, m in (("a", G.REPEAT), ("b", G.CLAMP), ("c", G.MIRROR))]).collect()}
    assert got[-1] == (3, 0, 0) and got[4] == (0, 3, 3) and got[5] == (1, 3, 2) and got[-9] == (3, 0, 0)
    texels = spark.createDataFrame([(x, y, 255 if x == 1 else 0) for x in range(2) for y in range(2)], "tx int, ty int, value long")
    point = spark.createDataFrame([(1, 0.5, 0.5)], "i int, u double, v double")
    assert G.sample_texels(point, texels, 2, "i").first().value == pytest.approx(0.5)


def test_grid_resolution():
    assert G.resolve_grid([0, 0, 0], [1, 2, 1], voxel=0.5)[3] == [2, 4, 2]
    low, high, _, size = G.resolve_grid([0], [1.1], voxel=0.5)
    assert size == [3] and low[0] == pytest.approx(-0.2) and high[0] == pytest.approx(1.3)
    with pytest.raises(ValueError, match="either"):
        G.resolve_grid([0], [1])


def test_scalar_functions(spark):
    df = spark.createDataFrame([(6, 0.5, [1.0, 2.0], [3.0, 5.0])], "n long, t double, a array<double>, e array<double>")
    r = df.select(
        S.radical_inverse(F.col("n"), 2).alias("r2"), S.radical_inverse(F.col("n"), 3).alias("r3"),
        S.velocity_to_x0(S.diffuse(F.col("a"), F.col("e"), F.col("t")), S.velocity(F.col("a"), F.col("e")), F.col("t")).alias("x0"),
        S.guide(F.col("a"), F.col("e"), 2.0).alias("g"), S.tone_map(F.lit(1e9)).alias("tm"), S.rel_error(F.lit(2.0), F.lit(1.0)).alias("re"),
        S.python_dict_value(F.lit("{'a': True, 'b': 'x'}"), "b").alias("d"), S.relative_path(F.lit("/r/a/b"), "/r").alias("p"),
        F.size(S.rotary(F.lit(1), F.lit(2), F.lit(3), 8)).alias("rot"), F.size(S.timestep_embedding(F.lit(1.0), 7)).alias("emb"),
        S.murmur_finaliser(F.lit(1)).alias("m"),
    ).first()
    assert r.r2 == 0.375 and r.r3 == pytest.approx(2 / 9)
    assert np.allclose(r.x0, [1.0, 2.0], atol=1e-4) and r.g == [-1.0, -1.0]
    assert (r.re, r.d, r.p, r.rot, r.emb) == (0.5, "x", "a/b", 8, 7) and r.tm == pytest.approx(1.0, abs=0.1)
    k = 1
    for shift, mult in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        k = (k ^ (k >> shift)) * mult % (1 << 32)
    assert r.m == k ^ (k >> 16)


def test_camera_functions(spark):
    m = [[0.0, -1.0, 0.0, 2.0], [1.0, 0.0, 0.0, 3.0], [0.0, 0.0, 1.0, 4.0], [0.0, 0.0, 0.0, 1.0]]
    got = spark.createDataFrame([(m,)], "m array<array<double>>").select(S.inverse_rigid(F.col("m")).alias("i")).first().i
    assert np.allclose(np.array(got) @ np.array(m), np.eye(4))


def test_colours_of_principal_components(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding")
    got = S.pca_colour(df, "embedding").select(F.array_min("colour").alias("a"), F.array_max("colour").alias("b")).agg(F.min("a"), F.max("b")).first()
    assert got[0] == pytest.approx(0) and got[1] == pytest.approx(1)


def test_mip_levels(spark):
    texels = spark.createDataFrame([(x, y, 200 if (x + y) % 2 else 100) for x in range(4) for y in range(4)], "tx int, ty int, value long")
    points = spark.createDataFrame([(0, 0.125, 0.875, -1.0), (1, 0.5, 0.5, 1.0), (2, 0.5, 0.5, 9.0), (3, 0.125, 0.875, 0.5)], "i int, u double, v double, level double")
    got = {r.i: r.value * 255 for r in G.sample_mipmapped(points, texels, 4, "i").collect()}
    assert got == pytest.approx({0: 100.0, 1: 150.0, 2: 150.0, 3: 125.0})


def closest(p, a, b, c):
    """Distance of p to a triangle by the Voronoi regions of its corners and edges; an independent way."""
    ab, ac, ap, bp, cp = b - a, c - a, p - a, p - b, p - c
    d1, d2, d3, d4, d5, d6 = ab @ ap, ac @ ap, ab @ bp, ac @ bp, ab @ cp, ac @ cp
    if d1 <= 0 and d2 <= 0:
        q = a
    elif d3 >= 0 and d4 <= d3:
        q = b
    elif d6 >= 0 and d5 <= d6:
        q = c
    elif (vc := d1 * d4 - d3 * d2) <= 0 <= d1 and d3 <= 0:
        q = a + ab * (d1 / (d1 - d3))
    elif (vb := d5 * d2 - d1 * d6) <= 0 <= d2 and d6 <= 0:
        q = a + ac * (d2 / (d2 - d6))
    elif (va := d3 * d6 - d5 * d4) <= 0 and d4 >= d3 and d5 >= d6:
        q = b + (c - b) * ((d4 - d3) / (d4 - d3 + d5 - d6))
    else:
        q = a + ab * (vb / (va + vb + vc)) + ac * (vc / (va + vb + vc))
    return float(np.linalg.norm(p - q))


SURFACE = "fid int, ax double, ay double, az double, bx double, by double, bz double, cx double, cy double, cz double"


def test_nearest_surface_is_brute_force(spark):
    rng = np.random.default_rng(3)
    tris = rng.random((30, 3, 3)) * 2
    pts = np.concatenate([rng.random((150, 3)) * 2, rng.normal(0, 6, (20, 3))])
    inner = np.concatenate([tris.mean(axis=1), tris[:, 0], (tris[:, 0] + tris[:, 1]) / 2])  # on a face, a corner, an edge
    pts = np.concatenate([pts, inner])
    rows = [(i, *map(float, t.ravel())) for i, t in enumerate(tris)]
    flat = [(90, 5.0, 5.0, 5.0, 5.0, 5.0, 5.0, 5.0, 5.0, 5.0), (91, 0.0, 0.0, 4.0, 1.0, 0.0, 4.0, 3.0, 0.0, 4.0)]  # a point, a line
    odd = [(92, float("nan"), *[0.0] * 8), (93, None, *[0.0] * 8)]
    surface = spark.createDataFrame([*rows, *rows[:5], *flat, *odd], SURFACE)
    asked = [(i, *map(float, p)) for i, p in enumerate(pts)] + [(-1, 5.0, 6.0, 5.0), (-2, 2.0, 0.0, 4.5), (-3, float("nan"), 0.0, 0.0), (-4, None, 0.0, 0.0)]
    table_ = spark.createDataFrame(asked, "pid int, px double, py double, pz double")
    got = {r.pid: (r.fid, r.dist) for r in G.nearest_surface(table_, surface, 0.25).collect()}
    assert set(got) == set(range(len(pts))) | {-1, -2}
    assert got[-1] == (90, 1.0) and got[-2] == (91, 0.5)
    line = [0, 1, 3]
    for i, p in enumerate(pts):
        d = [closest(p, *t) for t in tris] + [float(np.linalg.norm(p - 5)), float(np.linalg.norm(p - [min(max(p[0], line[0]), line[2]), 0, 4]))]
        assert got[i][1] == pytest.approx(min(d), abs=1e-9, rel=1e-9)
        at = got[i][0] if got[i][0] < 90 else got[i][0] - 60
        assert d[at] == pytest.approx(min(d), abs=1e-9, rel=1e-9)
    assert G.nearest_surface(table_, surface.limit(0), 0.25).count() == G.nearest_surface(table_.limit(0), surface, 0.25).count() == 0


def test_surface_lookup_meets_every_mesh(spark, sf):
    from lattica.plans.geometry_queries import _mesh
    from lattica.plans.registry import QUERIES

    v, f = _mesh(spark, sf)
    at = {(r.mesh, r.vid): np.array([r.x, r.y, r.z], float) for r in v.collect()}
    tris = {tuple(np.concatenate([at[r.mesh, r[k]] for k in ("v0", "v1", "v2")])) for r in f.collect()}
    ids = [r.event_id for r in spark.read.parquet(f"{sf}/events.parquet").select("event_id").collect()]
    got = {r.pid: r.dist for r in QUERIES["surface_lookup"](spark, sf).collect()}
    assert sorted(got) == sorted(ids)
    for i in ids[::25]:
        p = np.array([i % 17 / 17, i % 19 / 19, i % 23 / 23])
        assert got[i] == pytest.approx(min(closest(p, *np.reshape(t, (3, 3))) for t in tris), abs=2e-9)


def test_attention_covers_both_batches(spark, sf):
    from lattica.plans.registry import QUERIES
    from lattica.plans.spatial_queries import voxels

    cells = {(r.b, r.x, r.y, r.z): np.array([r.x, r.y, r.z, r.n]) / 10 for r in voxels(spark, sf).collect()}
    got = {(r.b, r.x, r.y, r.z): r.out for r in QUERIES["window_attention"](spark, sf).collect()}
    assert set(got) == set(cells) and {b for b, *_ in got} == {0, 1}
    window = lambda c: (c[0], *[(k + 2) // 4 for k in c[1:]])
    for at in sorted(cells)[::50]:
        near = np.array([f for c, f in cells.items() if window(c) == window(at)])
        w = np.exp(near @ cells[at] / 2)
        assert np.allclose(got[at], w @ near / w.sum(), atol=2e-6)


def test_group_norm_covers_all_components(spark, sf):
    from lattica.plans.registry import QUERIES

    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    got = {r.vec_id: r.f for r in QUERIES["segment_group_norm"](spark, sf).collect()}
    for label in {r.label for r in rows}:
        ids, x = zip(*[(r.vec_id, r.embedding) for r in rows if r.label == label], strict=True)
        x = np.array(x, float).reshape(len(ids), -1, 4)
        want = (x - x.mean(axis=(0, 2), keepdims=True)) / np.sqrt(x.var(axis=(0, 2), keepdims=True) + 1e-5)
        assert np.allclose([got[i] for i in ids], want.reshape(len(ids), -1), atol=2e-6)


@pytest.mark.parametrize("name", ["textured_volume", "mesh_to_grid", "dual_cells", "grid_to_triangles", "surface_lookup"])
def test_mesh_rows_never_pass_the_driver(spark, sf, name, monkeypatch):
    """Estimates leave out exploded rows, so that small tables of parts look small as meshes, too: no such side may be broadcast."""
    from lattica.operators import volumes
    from lattica.plans import geometry_queries
    from lattica.plans.registry import QUERIES

    plans = []

    def planned(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    for module in (G, volumes, geometry_queries):
        monkeypatch.setattr(module, "checkpoint", lambda df, real=module.checkpoint: real(planned(df)))
    planned(QUERIES[name](spark, sf))
    assert len(plans) > 1
    assert not [p for p in plans if "BroadcastExchange" in p and "p_size" not in p]  # the texture's 256 sums of p_size may be


def test_crossed_edges_are_those_of_the_scan(spark):
    """Once each, whatever triangles of a mesh share them; and the four cells around each are cells of the scan."""
    rng = np.random.default_rng(5)
    grid, t = 22, rng.random((12, 3, 3)) * 22
    t[:3], t[3] = np.round(t[:3] / 4) * 4, t[2, [1, 2, 0]]  # on grid planes and block sides, and one twice
    rows = [(int(i % 3), i, *map(float, p.ravel())) for i, p in enumerate(t)]
    df = spark.createDataFrame(rows, "mesh int, fid int, " + ", ".join(f"{c}{a} double" for c in "abc" for a in "xyz"))
    hits = [(h[0] % 3, *h[1:6]) for h in rows_of(G._cells_around(t, 1.0, grid))]
    got = [tuple(r) for r in G.crossed_edges(df, 1.0, grid).collect()]
    assert len(got) > 500 and len(got) == len(set(got)) < sum(h[2] for h in hits)
    assert set(got) == {(h[0], h[1], *h[3:]) for h in hits if h[2]}
    cells = {(h[0], *h[3:]) for h in hits}
    assert all((mesh, x + i, y + j, z + k) in cells for mesh, axis, x, y, z in got for i, j, k in K.QUAD[axis])


@pytest.mark.parametrize("name", ["grid_to_triangles", "textured_volume"])
def test_mesh_rows_take_little_disk(spark, sf, name, monkeypatch):
    """No row per cell is kept or shuffled: a part has over a hundred of them."""
    from lattica.operators import volumes
    from lattica.plans import geometry_queries
    from lattica.plans.registry import QUERIES

    parts, kept = spark.read.parquet(f"{sf}/part.parquet").count(), []

    def counted(df, real):
        kept.append((out := real(df)).count())
        return out

    for module in (G, volumes, geometry_queries):
        monkeypatch.setattr(module, "checkpoint", lambda df, real=module.checkpoint: counted(df, real))
    written = lambda: spark._jsc.sc().statusStore().executorList(True).apply(0).totalShuffleWrite()
    before = written()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    spark._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    assert written() - before < 2000 * parts
    assert sum(kept) <= 10 * parts


def test_blocks_have_all_cells():
    """The cells of a triangle in the blocks that it reaches are those of the scan, also of planes nearly parallel to an axis."""
    rng = np.random.default_rng(3)
    grid, t = 37, rng.random((30, 3, 3)) * 44 - 4
    t[:8] = t[:8, :1] + rng.random((8, 3, 3)) * 3
    t[8:12, :, 2] = 16 + rng.random((4, 3)) * 1e-9
    t[12, 0, 0] = np.nan
    blocks = rows_of(G._reached(t, 1.0, grid))
    assert len(blocks) == len(set(blocks)) and 12 not in {b[0] for b in blocks}
    tri, block = np.array([b[0] for b in blocks]), np.array([b[1:] for b in blocks])
    own, cell = G.cells_in_block(t[tri], block, 1.0, grid)
    places = block[own] * G.CUT + np.stack((cell // G.CUT**2, cell // G.CUT % G.CUT, cell % G.CUT), axis=1)
    got = [(int(tri[i]), *p) for i, p in zip(own, places.tolist(), strict=True)]
    t = np.delete(t, 12, axis=0)
    assert len(got) == len(set(got)) > 5000
    assert set(got) == {(h[0] + (h[0] >= 12), *h[3:6]) for h in rows_of(G._cells_around(t, 1.0, grid))}


@pytest.mark.parametrize("smooth", [False, True])
def test_volumes_held_and_joined_agree(spark, monkeypatch, smooth):
    """Meshes over many blocks, triangles of all sizes, every slot, wrap and alpha mode, a texture with holes, one that isn't listed."""
    from lattica.operators import volumes as V

    rng = np.random.default_rng(4)
    names = [f"{c}{a}" for c in "abc" for a in ("x", "y", "z", "u", "v", *(("nx", "ny", "nz") if smooth else ()))]
    rows = []
    for fid in range(40):
        start, span = rng.random(3) * 30, (1, 4, 30)[fid % 3]
        rows.append((f"m{fid % 3}", fid, int(fid % 4), *[float(x) for _ in range(3) for x in (*(start + rng.random(3) * span), *(rng.random(2) * 3 - 1), *(rng.random(3) if smooth else ()))]))
    rows += [(None, 40, 0, *rows[0][3:]), rows[2], rows[2], rows[3]]  # without a mesh, and repeated
    df = spark.createDataFrame(rows, "mesh string, fid int, mat int, " + ", ".join(f"{n} double" for n in names))
    slots = [(1, None, 2, 3, 3, 2), (2, 1, None, None, 1, None), (3, 3, 4, 1, 2, 1), (None,) * 6]  # of 4 there is no texture
    factors = [([0.5, 1.0, 0.25], 0.75, 1.0, [1.0, 0.5, 2.0], 0.5, 0.5, "BLEND"), ([1.0, 1.0, 1.0], 0.1, 0.5, [0.0] * 3, 1.0, 0.5, "MASK"), ([0.3, None, 1.0], None, 0.25, [0.2] * 3, 0.5, 0.5, None), ([1.0] * 3, 1.0, 1.0, [0.0] * 3, 0.5, 0.5, "OPAQUE")]
    schema = "mat int, base_factor array<double>, metallic_factor double, roughness_factor double, emissive_factor array<double>, alpha_factor double, alpha_cutoff double, alpha_mode string, " + ", ".join(f"{s}_tex int" for s in V.SLOTS)
    materials = spark.createDataFrame([(i, *f, *s) for i, (f, s) in enumerate(zip(factors, slots, strict=True))], schema)
    textures = spark.createDataFrame([(1, 16, G.REPEAT, True), (2, 8, G.MIRROR, True), (3, 5, G.CLAMP, False)], "tex int, size int, wrap int, linear boolean")
    texels = spark.createDataFrame([(t, x, y, *map(int, rng.integers(0, 256, 3))) for t, n in ((1, 16), (2, 8), (3, 5)) for x in range(n) for y in range(n) if (t, x % 3) != (3, 1)], "tex int, tx int, ty int, c0 long, c1 long, c2 long")
    run = lambda: {(r.mesh, r.x, r.y, r.z): r[4:] for r in V.volumetric_attributes(df, materials, textures, texels, 1.0, 40, 2.0).collect()}
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    held, default = run(), spark.conf.get(batch)
    try:
        spark.conf.set(batch, "3")  # a block's rows in many batches
        assert (again := run()).keys() == held.keys()
    finally:
        spark.conf.set(batch, default)
    monkeypatch.setattr(V, "HELD_TEXELS", 0)
    joined = run()
    assert len(joined) > 900 and held.keys() == joined.keys()
    number = lambda rows: np.array([rows[k] for k in joined], float)
    assert np.allclose(number(held), number(joined), atol=1e-6, equal_nan=True) and np.allclose(number(held), number(again), atol=1e-9, equal_nan=True)
    with pytest.raises(Exception, match="no material 9"):
        V.volumetric_attributes(df.withColumn("mat", F.lit(9)), materials, textures, texels, 1.0, 40).collect()


@pytest.mark.parametrize("name", ["grid_to_triangles", "textured_volume"])
def test_parts_without_a_key_have_no_mesh(spark, sf, name, tmp_path):
    from lattica.plans.registry import QUERIES

    parts = spark.read.parquet(f"{sf}/part.parquet").where("p_partkey < 40")
    for at, key in (("whole", F.col("p_partkey")), ("holed", F.when(F.col("p_partkey") % 5 > 0, F.col("p_partkey")))):
        parts.withColumn("p_size", F.lit(1)).withColumn("p_partkey", key).write.parquet(str(tmp_path / at / "part.parquet"))
    whole, holed = (QUERIES[name](spark, str(tmp_path / at)) for at in ("whole", "holed"))
    mesh = whole.columns[0]
    assert holed.select(mesh, "v0" if "v0" in holed.columns else "x").exceptAll(whole.where(F.col(mesh) % 5 > 0).select(mesh, "v0" if "v0" in whole.columns else "x")).count() == 0
    assert holed.count() == whole.where(F.col(mesh) % 5 > 0).count() > 0
