"""Textured meshes as volumes: the cells that a mesh's surface meets, with the material attributes found there.

triangles(mesh, fid, mat, ax ... cz, au ... cv), materials(mat, factors, texture ids), textures(tex, size, wrap, linear) and
texels(tex, tx, ty, c0, c1, c2; 0 ... 255). While textures and materials are few enough for every task to hold, triangles are
shuffled once, by blocks of their mesh, and each block's cells are found, sampled and summed up in one pass. Beyond that everything but the
crossing of triangles with grid lines is a join or a partial aggregation: every texel that a sample needs is one row of one
equi-join, whatever the texture's size or level.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lattica.operators import geometry as G
from lattica.session import checkpoint, ship, unbounded

#: Texture slots of a material, and the channels that each has.
SLOTS = {"base": 3, "metallic": 1, "roughness": 1, "emissive": 3, "alpha": 1, "normal": 3}
CHANNELS = ("c0", "c1", "c2")
#: Texels, mips included, and materials that tasks hold at most (24 bytes a texel).
HELD_TEXELS, HELD_MATERIALS = 1 << 20, 1 << 12


def names(slot: str) -> list[str]:
    """The result columns of a slot."""
    return [slot] if SLOTS[slot] == 1 else [f"{slot}_{c}" for c in ("xyz" if slot == "normal" else "rgb")]


def pyramid(texels: DataFrame, textures: DataFrame) -> DataFrame:
    """(tex, level, tx, ty, c0, c1, c2): textures with all their mips, truncated means of 2 x 2 down to one texel. Only linear
    textures have mips; their sides are powers of two."""
    largest = textures.where("linear").agg(F.max("size")).first()[0] or 1
    now = checkpoint(texels.select("tex", F.lit(0).alias("level"), "tx", "ty", *CHANNELS))  # else every level makes all those below it again
    out = now
    sides = textures.where("linear").select("tex", "size")
    for level in range(1, int(largest).bit_length()):
        there = sides.where(F.col("size") >= (1 << level)).select("tex")
        half = [F.floor(F.col(c) / 2).cast("int").alias(c) for c in ("tx", "ty")]
        now = now.join(there, "tex", "left_semi").groupBy("tex", *half).agg(*[F.floor(F.sum(c) / 4).cast("long").alias(c) for c in CHANNELS])
        now = checkpoint(now.select("tex", F.lit(level).alias("level"), "tx", "ty", *CHANNELS))
        out = out.unionByName(now)
    return out


def sample(points: DataFrame, textures: DataFrame, levels: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, c0, c1, c2) of points (key, tex, u, v, footprint), 0 ... 1: nearest, or bilinear in the two mips around the footprint's
    level. A level that isn't above 0 or isn't finite reads the texture itself, one beyond the last mip that mip. key names one
    sample."""
    rows = points.join(textures, "tex")
    last = F.log2("size").cast("int")
    level = F.log2(F.col("footprint") * F.col("size"))
    usable = F.col("linear") & F.coalesce((level > 0) & (F.abs(level) < float("inf")), F.lit(False))
    read = lambda at, weight: F.struct(at.cast("int").alias("level"), weight.cast("double").alias("weight"))
    both = F.when(~usable, F.array(read(F.lit(0), F.lit(1.0)))).when(level >= last, F.array(read(last, F.lit(1.0)))).otherwise(
        F.array(read(F.floor(level), 1 - (level - F.floor(level))), read(F.floor(level) + 1, level - F.floor(level)))
    )
    rows = rows.select(*key, "tex", "u", "v", "size", "wrap", "linear", F.explode(both).alias("l")).select("*", "l.level", "l.weight").drop("l")
    rows = rows.withColumn("side", F.call_function("shiftright", F.col("size").cast("int"), F.col("level")))
    x, y = F.col("u") * F.col("side"), (1 - F.col("v")) * F.col("side")
    x0, y0 = F.floor(x - 0.5), F.floor(y - 0.5)
    wx, wy = x - x0 - 0.5, y - y0 - 0.5
    wrapped = lambda i: G.wrap(i.cast("int"), F.col("side"), F.col("wrap"))
    tap = lambda i, j, w: F.struct(wrapped(i).alias("tx"), wrapped(j).alias("ty"), w.alias("tap"))
    four = F.array(*[tap(x0 + i, y0 + j, (wx if i else 1 - wx) * (wy if j else 1 - wy)) for i in (0, 1) for j in (0, 1)])
    taps = F.when(F.col("linear"), four).otherwise(F.array(tap(F.floor(x), F.floor(y), F.lit(1.0))))
    rows = rows.select(*key, "tex", "level", "weight", F.explode(taps).alias("t")).select(*key, "tex", "level", "t.tx", "t.ty", (F.col("weight") * F.col("t.tap")).alias("weight"))
    met = rows.join(levels, ["tex", "level", "tx", "ty"])
    return met.groupBy(*key).agg(*[(F.sum(F.col("weight") * F.col(c)) / 255).alias(c) for c in CHANNELS])


def _value(slot: str, i: int) -> Column:
    """A channel at a cell of a triangle: the sample, 1 without a texture, times the material's factor."""
    texture = F.coalesce(F.col(f"{slot}.c{i}"), F.lit(1.0))
    return texture * (F.get(f"{slot}_factor", F.lit(i)) if SLOTS[slot] > 1 else F.col(f"{slot}_factor"))


class Held:
    """Materials and textures as arrays, in a task."""

    def __init__(self, materials: list, textures: list, levels: pa.Table):
        number = {t.tex: i for i, t in enumerate(textures)}
        self.size = np.array([t.size for t in textures], np.int64)
        self.mode = np.array([G.REPEAT if t.wrap is None else t.wrap for t in textures], np.int64)
        self.linear = np.array([bool(t.linear) for t in textures], bool)
        self.last = np.array([int(t.size).bit_length() - 1 for t in textures], np.int64)
        sides = [[t.size >> k for k in range(int(t.size).bit_length() if t.linear else 1)] for t in textures]
        self.begin = np.full((len(textures), max(map(len, sides), default=1) + 1), -1, np.int64)
        total = 0
        for i, of in enumerate(sides):
            for k, side in enumerate(of):
                self.begin[i, k], total = total, total + side * side
        self.channels = np.full((3, total), np.nan)
        column = lambda c: levels.column(c).to_numpy()
        known = pc.index_in(levels.column("tex"), value_set=pa.array(number, levels.schema.field("tex").type)).to_numpy() if number else np.zeros(0)
        tex, level, tx, ty = (np.nan_to_num(c, nan=-1).astype(np.int64) for c in (known, *map(column, ("level", "tx", "ty"))))
        side = np.where(tex >= 0, self.size[tex] >> level, 0) if len(tex) else tex
        there = (tx >= 0) & (tx < side) & (ty >= 0) & (ty < side)
        at = self.begin[tex[there], level[there]] + ty[there] * side[there] + tx[there]
        for i, c in enumerate(CHANNELS):
            self.channels[i, at] = column(c)[there]
        self.whole = not np.isnan(self.channels).any()
        self.mats = [m.mat for m in materials]
        self.tex = {s: np.array([number.get(m[f"{s}_tex"], -1) for m in materials], np.int64) for s in SLOTS}
        real = lambda x: np.nan if x is None else float(x)
        listed = lambda x, n: ([*(x or ()), *[None] * n] if n > 1 else [x])[:n]
        self.factor = {s: np.array([[real(x) for x in listed(m[f"{s}_factor"], n)] for m in materials]).reshape(len(materials), n) for s, n in SLOTS.items() if s != "normal"}
        self.mask = np.array([m.alpha_mode == "MASK" for m in materials], bool)
        self.opaque = np.array([m.alpha_mode == "OPAQUE" for m in materials], bool)
        self.cutoff = np.array([real(m.alpha_cutoff) for m in materials])

    def sample(self, tex: np.ndarray, u: np.ndarray, v: np.ndarray, footprint: np.ndarray, channels: int) -> np.ndarray:
        """(channels, n): as `sample`; nan where no texel is met."""
        out = np.full((channels, len(tex)), np.nan)
        rows = np.flatnonzero((tex >= 0) & ~np.isnan(u) & ~np.isnan(v))
        tex, u, v = tex[rows], u[rows], v[rows]
        size, mode, linear, last = self.size[tex], self.mode[tex], self.linear[tex], self.last[tex]
        with np.errstate(all="ignore"):
            level = np.log2(footprint[rows] * size)
            level = np.where(linear & (level > 0) & np.isfinite(level), np.minimum(level, last), 0.0)
        low = np.floor(level).astype(np.int64)
        total, met = np.zeros((channels, len(rows))), np.zeros((channels, len(rows)), bool)
        for upper in (False, True):
            at = np.flatnonzero(level > low) if upper else slice(None)
            here = low[at] + upper
            part = level[at] - low[at]
            side, begin, soft = size[at] >> here, self.begin[tex[at], here], linear[at]
            x, y = u[at] * side, (1 - v[at]) * side
            x0, y0 = (np.floor(np.where(soft, c - 0.5, c)) for c in (x, y))
            wx, wy = (np.where(soft, c - c0 - 0.5, 0.0) for c, c0 in ((x, x0), (y, y0)))
            share = part if upper else 1 - part
            tx, ty = ([_wrapped(c.astype(np.int64) + i, side, mode[at]) for i in (0, 1)] for c in (x0, y0))
            for i in (0, 1):
                for j in (0, 1):
                    weight = share * (wx if i else 1 - wx) * (wy if j else 1 - wy)
                    spot = begin + ty[j] * side + tx[i]
                    for c in range(channels):
                        value = self.channels[c][spot]
                        if self.whole:
                            total[c, at] += weight * value
                            met[c, at] = True
                        else:
                            good = ~np.isnan(value) & (soft | (i + j == 0))
                            total[c, at] += np.where(good, weight * np.nan_to_num(value), 0.0)
                            met[c, at] |= good
        out[:, rows] = np.where(met, total / 255, np.nan)
        return out


def _wrapped(i: np.ndarray, side: np.ndarray, mode: np.ndarray) -> np.ndarray:
    """As geometry.wrap."""
    out = i % side
    if (mode == G.CLAMP).any():
        out = np.where(mode == G.CLAMP, np.clip(i, 0, side - 1), out)
    if (mode == G.MIRROR).any():
        turn = i % (2 * side)
        out = np.where(mode == G.MIRROR, np.where(turn < side, turn, 2 * side - turn - 1), out)
    return out


def _hold(materials: DataFrame, textures: DataFrame, texels: DataFrame) -> Held | None:
    """None if they are more than tasks may hold."""
    listed = materials.limit(HELD_MATERIALS + 1).collect()
    area = textures.agg(F.sum(F.col("size").cast("double") * F.col("size") * 4 / 3)).first()[0] or 0
    if len(listed) > HELD_MATERIALS or area > HELD_TEXELS:
        return None
    levels = pyramid(texels.join(unbounded(textures.select("tex")), "tex", "left_semi"), textures)
    return Held(listed, textures.collect(), levels.select("tex", "level", "tx", "ty", *[F.col(c).cast("double").alias(c) for c in CHANNELS]).toArrow())


def _values(held: Held, mat: np.ndarray, own: dict[str, np.ndarray], at: np.ndarray, cell: np.ndarray, voxel: float, smooth: bool) -> tuple[np.ndarray, list[np.ndarray]]:
    """(weight, a value of each result column) at the middles of cells of the triangles `at`."""
    col = lambda c: own[c][at]
    three = lambda *names: np.stack([own[n] for n in names], axis=1)
    a, normal = three("ax", "ay", "az"), three("nx", "ny", "nz")
    ab, ac = three("bx", "by", "bz") - a, three("cx", "cy", "cz") - a
    inner = lambda p, q: np.einsum("nk,nk->n", p, q)
    d00, d01, d11 = inner(ab, ab), inner(ab, ac), inner(ac, ac)
    area = d00 * d11 - d01 * d01
    area = np.where(area == 0, np.nan, area)[at]
    place, flat = (cell + 0.5) * voxel, normal[at]
    off = inner(place - a[at], flat)
    along = place - off[:, None] * flat - a[at]
    d20, d21 = inner(along, ab[at]), inner(along, ac[at])
    b1, b2 = (d11[at] * d20 - d01[at] * d21) / area, (d00[at] * d21 - d01[at] * d20) / area
    b0 = 1 - b1 - b2
    mixed = lambda p, q, r: b0 * col(p) + b1 * col(q) + b2 * col(r)
    u, v, footprint, which = mixed("au", "bu", "cu"), mixed("av", "bv", "cv"), col("footprint"), mat[at]

    def read(slot: str) -> np.ndarray:
        tex = held.tex[slot]
        return held.sample(tex[which], u, v, footprint, SLOTS[slot]) * col("times") if (tex >= 0).any() else np.full((SLOTS[slot], len(at)), np.nan)

    value = {}
    for slot in ("base", "metallic", "roughness", "emissive", "alpha"):
        found = read(slot)
        value |= {n: np.where(np.isnan(found[i]), 1.0, found[i]) * held.factor[slot][which, i] for i, n in enumerate(names(slot))}
    alpha = value["alpha"]
    value["alpha"] = np.where(held.opaque[which], 1.0, np.where(held.mask[which], (alpha >= held.cutoff[which]).astype(float), alpha))
    bent = read("normal")
    facing = np.stack([mixed(f"an{k}", f"bn{k}", f"cn{k}") for k in "xyz"]) if smooth else flat.T
    if not np.isnan(bent).all():
        s = bent * 2 - 1
        turned = s[0] * three("tx", "ty", "tz")[at].T + s[1] * three("bx_", "by_", "bz_")[at].T + s[2] * facing
        length = np.sqrt((turned**2).sum(axis=0))
        facing = np.where(np.isnan(bent).all(axis=0), facing, turned / np.where(length > 0, length, 1.0))
    value |= dict(zip(names("normal"), facing, strict=True))
    return 1 - off, [value[n] for s in SLOTS for n in names(s)]


def _blocks_summed(laid: DataFrame, held: Held, voxel: float, grid: int, smooth: bool) -> DataFrame:
    """(mesh, x, y, z, result columns) of triangles whose rows come block by block, as cut_to_blocks deals them. The sums of the last
    block wait for its next rows, so that a task holds those of one block and of some PAIRS crossings."""
    ship(laid.sparkSession)
    shown = [n for s in SLOTS for n in names(s)]
    size = G.CUT**3
    real = [c for c in laid.columns if c not in ("mesh", "mat", "gx", "gy", "gz")]

    def result(mesh: pa.Array, block: np.ndarray, cell: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        """sums: of weights, then of each column and of the rows that have it."""
        k = len(shown)
        with np.errstate(all="ignore"):
            means = [np.where(sums[:, 1 + k + i] > 0, sums[:, 1 + i] / sums[:, 0], np.nan) for i in range(k)]
        places = [block[:, i] * G.CUT + cell // G.CUT ** (2 - i) % G.CUT for i in range(3)]
        return pa.RecordBatch.from_arrays([mesh, *[pa.array(p.astype(np.int32)) for p in places], *[pa.array(m, mask=(sums[:, 0] == 0) | np.isnan(m)) for m in means]], names=["mesh", *"xyz", *shown])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wait = None  # (mesh, block, cells, sums) of the last block
        for batch in batches:
            if not batch.num_rows:
                continue
            mesh = batch.column("mesh")
            code = mesh.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            block = np.stack([batch.column(f"g{k}").to_numpy() for k in "xyz"], axis=1).astype(np.int64)
            mat = pc.index_in(batch.column("mat"), value_set=pa.array(held.mats, batch.schema.field("mat").type)).to_numpy(zero_copy_only=False).astype(np.int64)
            own = {c: batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in real}
            t = np.stack([own[f"{c}{a}"] for c in "abc" for a in "xyz"], axis=1).reshape(-1, 3, 3)
            fresh = np.append(True, (np.diff(code) != 0) | (np.diff(block, axis=0) != 0).any(axis=1))
            side = np.minimum((t.max(axis=1) - t.min(axis=1)) / voxel + 2, G.CUT + 1)
            ends = np.cumsum(side[:, 0] * side[:, 1] + side[:, 1] * side[:, 2] + side[:, 2] * side[:, 0])
            cuts = np.flatnonzero(np.diff(ends // (G.PAIRS // 4), prepend=0.0, append=np.inf))
            for start, stop in zip([0, *cuts[:-1]], cuts, strict=True):
                if start == stop:
                    continue
                some = slice(start, stop)
                tri, cell = G.cells_in_block(t[some], block[some], voxel, grid)
                group = np.cumsum(fresh[some]) - fresh[start]
                if wait is not None and (fresh[start] if start else not (wait[0][0] == mesh[0] and (wait[1] == block[0]).all())):
                    yield result(wait[0].take(pa.array(np.zeros(len(wait[2]), np.int64))), np.tile(wait[1], (len(wait[2]), 1)), *wait[2:])
                    wait = None
                whole = np.stack([cell // G.CUT ** (2 - i) % G.CUT for i in range(3)], axis=1) + block[some][tri] * G.CUT
                weight, values = _values(held, mat[some], {c: x[some] for c, x in own.items()}, tri, whole, voxel, smooth)
                has = [~np.isnan(x) for x in values]
                parts = [weight, *[np.where(h, weight * x, 0.0) for h, x in zip(has, values, strict=True)], *has]
                key = group[tri] * size + cell
                if wait is not None:
                    key, parts = np.append(wait[2], key), [np.append(w, x) for w, x in zip(wait[3].T, parts, strict=True)]
                key, place = np.unique(key, return_inverse=True)
                sums = np.stack([np.bincount(place, weights=x, minlength=len(key)) for x in parts], axis=1)
                of = key // size
                first = np.flatnonzero(np.diff(group, prepend=-1)) + start  # a row of each group
                done = int(np.searchsorted(of, group[-1]))
                if done:
                    yield result(mesh.take(pa.array(first[of[:done]])), block[first[of[:done]]], key[:done] % size, sums[:done])
                wait = mesh.slice(int(first[-1]), 1), block[first[-1]], key[done:] % size, sums[done:]
        if wait is not None:
            yield result(wait[0].take(pa.array(np.zeros(len(wait[2]), np.int64))), np.tile(wait[1], (len(wait[2]), 1)), *wait[2:])

    return laid.mapInArrow(run, f"mesh {laid.schema['mesh'].dataType.simpleString()}, x int, y int, z int, " + ", ".join(f"{n} double" for n in shown))


def _framed(triangles: DataFrame, voxel: float, mip_offset: float) -> DataFrame:
    frame = {f"{n}_" if n[0] == "b" else n: c for n, c in G.tangent_frame().items()}  # bx, by, bz name a corner
    laid = G.with_normals(triangles).withColumns(frame)
    return laid.withColumn("footprint", F.lit(voxel) / F.sqrt(F.col("mu") * F.col("mv")) * 2.0**mip_offset)


def volumetric_attributes(triangles: DataFrame, materials: DataFrame, textures: DataFrame, texels: DataFrame, voxel: float, grid: int, mip_offset: float = 0.0) -> DataFrame:
    """(mesh, x, y, z, base_r ... normal_z): the cells around the grid edges that each mesh's triangles cross. A triangle gives a cell
    its attributes at the projection of the cell's centre, weighing 1 less the centre's distance in front of its plane.

    A material without a texture in a slot has its factor there; one that a triangle names but isn't listed is an error. fid names one
    triangle of a mesh; the samples of a repeated row are summed up, as those of one key are. Triangles
    may have vertex normals anx ... cnz; else the face's is taken, and a normal map bends either."""
    smooth = "anx" in triangles.columns
    if held := _hold(materials, textures, texels):
        used = ["mesh", "fid", "mat", *[f"{c}{k}" for c in "abc" for k in ("x", "y", "z", "u", "v", *(("nx", "ny", "nz") if smooth else ()))]]
        listed = F.when(F.col("mesh").isNull() | F.col("fid").isNull(), False).when(F.col("mat").isin(held.mats), True).otherwise(F.raise_error(F.concat(F.lit("no material "), F.col("mat").cast("string"))).cast("boolean"))
        laid = G.cut_to_blocks(triangles.where(listed).select(*used), voxel, grid)
        laid = laid.withColumn("times", F.count("*").over(W.partitionBy("mesh", "gx", "gy", "gz", "fid")))  # in the order they have
        return _blocks_summed(_framed(laid, voxel, mip_offset).drop("fid", "nd", "mu", "mv"), held, voxel, grid, smooth)
    laid = _framed(triangles, voxel, mip_offset)
    keep = ["mesh", "fid"]
    hit = G.scan_convert(laid, voxel, grid, keep).select(*keep, "x", "y", "z").distinct()
    found = materials.withColumn("__there", F.lit(True))
    laid = laid.join(found, "mat", "left")
    laid = laid.where(F.when(F.col("__there"), True).otherwise(F.raise_error(F.concat(F.lit("no material "), F.col("mat").cast("string"))).cast("boolean"))).drop("__there")
    cells = unbounded(hit).join(laid, keep)
    centre = {f"p{a}": (F.col(a) + 0.5) * voxel for a in "xyz"}
    cells = cells.withColumns(centre)
    place = G.barycentric(G.vector("px", "py", "pz"), G.vector("nx", "ny", "nz"))
    cells = cells.withColumns({"b0": place["u"], "b1": place["v"], "b2": place["w"], "weight": 1 - place["d"]})
    mixed = lambda *c: sum((F.col(f"b{i}") * F.col(n) for i, n in enumerate(c[1:], 1)), F.col("b0") * F.col(c[0]))
    own = {f"own{a}": mixed(f"an{a}", f"bn{a}", f"cn{a}") if smooth else F.col(f"n{a}") for a in "xyz"}
    cells = checkpoint(cells.withColumns({"u": mixed("au", "bu", "cu"), "v": mixed("av", "bv", "cv"), **own}))  # asked, and joined with the answers
    key = [*keep, "x", "y", "z"]
    wanted = F.filter(F.array(*[F.struct(F.lit(s).alias("slot"), F.col(f"{s}_tex").alias("tex")) for s in SLOTS]), lambda t: t["tex"].isNotNull())
    asked = cells.select(*key, "u", "v", "footprint", F.explode(wanted).alias("t")).select(*key, "u", "v", "footprint", "t.slot", "t.tex")
    got = sample(asked, textures, pyramid(texels, textures), [*key, "slot"])
    got = got.groupBy(*key).agg(*[F.max(F.when(F.col("slot") == s, F.struct(*CHANNELS))).alias(s) for s in SLOTS])
    rows = cells.join(unbounded(got), key, "left")
    value = {n: _value(s, i) for s in ("base", "metallic", "roughness", "emissive") for i, n in enumerate(names(s))}
    value["alpha"] = G.alpha_rule(F.col("alpha_mode"), F.col("alpha_factor"), F.col("alpha.c0"), F.col("alpha_cutoff"))
    own_normal = G.vector("ownx", "owny", "ownz")
    bent = G.decode_normal(tuple(F.col(f"normal.{c}") for c in CHANNELS), G.vector("tx", "ty", "tz"), G.vector("bx_", "by_", "bz_"), own_normal)
    value |= {n: F.when(F.col("normal").isNull(), o).otherwise(b) for n, o, b in zip(names("normal"), own_normal, bent, strict=True)}
    rows = rows.select("mesh", "x", "y", "z", "weight", *[c.alias(f"__{n}") for n, c in value.items()])
    return rows.groupBy("mesh", "x", "y", "z").agg(*[F.try_divide(F.sum(F.col("weight") * F.col(f"__{n}")), F.sum("weight")).alias(n) for n in value])
