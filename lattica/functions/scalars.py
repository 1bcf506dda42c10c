"""Scalar, array and string functions as column expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bases of the low-discrepancy sequences.
PRIMES = (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37, 41, 43, 47, 53)


def clip(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(c, F.lit(high)), F.lit(low))


def quantise_unit(c: Column) -> Column:
    """0 ... 1 to 0 ... 255: clamped, then truncated."""
    return (clip(c, 0.0, 1.0) * 255).cast("int")


def pack_flags(a: Column, b: Column, c: Column) -> Column:
    return a.cast("int") + b.cast("int") * 2 + c.cast("int") * 4


def unpack_flags(v: Column) -> Column:
    return F.array(*[F.getbit(v.cast("int"), F.lit(i)) == 1 for i in range(3)])


def all_finite(feats: Column) -> Column:
    return F.coalesce(F.forall(feats, lambda x: ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def in_range(c: Column, low: float, high: float, slack: float = 0.0) -> Column:
    """c, or an error outside [low - slack, high + slack]."""
    return F.when(c.between(low - slack, high + slack), c).otherwise(F.raise_error(F.format_string("value %s out of range", c.cast("string"))))


def to_signed_unit(byte: Column) -> Column:
    return byte / 255 * 2 - 1


def from_signed_unit(c: Column) -> Column:
    return c * 0.5 + 0.5


def radical_inverse(n: Column, base: int, digits: int = 32) -> Column:
    """Digits of n in the base, mirrored behind the point; n < base ** digits."""
    zero = F.struct(n.cast("long").alias("n"), F.lit(0.0).alias("v"), F.lit(1.0 / base).alias("s"))
    step = lambda acc, _: F.struct(
        F.floor(acc["n"] / base).cast("long").alias("n"), (acc["v"] + F.pmod(acc["n"], F.lit(base)) * acc["s"]).alias("v"), (acc["s"] / base).alias("s")
    )
    count = min(digits, math.ceil(63 / math.log2(base)))
    return F.aggregate(F.sequence(F.lit(1), F.lit(count)), zero, step)["v"]


def halton(n: Column, dim: int) -> Column:
    return F.array(*[radical_inverse(n, PRIMES[i]) for i in range(dim)])


def hammersley(n: Column, dim: int, total: int) -> Column:
    return F.array(n / total, *[radical_inverse(n, PRIMES[i]) for i in range(dim - 1)])


def sphere_view(n: Column, total: int, offset: tuple[float, float] = (0.0, 0.0), remap: bool = True) -> Column:
    """struct<yaw, pitch> of view n: a Hammersley point wrapped around the sphere; remap thins the top."""
    u = n / total + offset[0] / total
    v = radical_inverse(n, 2) + offset[1]
    if remap:
        u = F.when(u < 0.25, u * 2).otherwise(u * 2 / 3 + 1 / 3)
    return F.struct((v * 2 * math.pi).alias("yaw"), (F.acos(clip(1 - u * 2, -1.0, 1.0)) - math.pi / 2).alias("pitch"))


def hash_uniform(*parts: Column) -> Column:
    """A number in [0, 1) from a hash of the parts: the same in every run."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)).cast("double") / float(1 << 52)


def hash_normal(*parts: Column) -> Column:
    u, v = hash_uniform(*parts, F.lit("u")), hash_uniform(*parts, F.lit("v"))
    return F.sqrt(F.log(1 - u) * -2) * F.cos(v * 2 * math.pi)


def camera(u: Column, near: float, far: float) -> Column:
    """struct<radius, fov>: even in 1 / r^2 between two radii; fov holds the unit cube's sphere."""
    k = u * (1 / near**2 - 1 / far**2) + 1 / far**2
    radius = 1 / F.sqrt(k)
    return F.struct(radius.alias("radius"), (F.asin(clip(math.sqrt(3) / 2 / radius, 0.0, 1.0)) * 2).alias("fov"))


def look_at(eye: Sequence[Column], target: Sequence[float] = (0, 0, 0), up: Sequence[float] = (0, 0, 1)) -> Column:
    """array of the 12 numbers of the world-to-camera rows [right, down, forward | t]."""
    f = [F.lit(float(t)) - e for e, t in zip(eye, target, strict=True)]
    length = F.sqrt(f[0] * f[0] + f[1] * f[1] + f[2] * f[2])
    f = [c / length for c in f]
    r = [f[1] * up[2] - f[2] * up[1], f[2] * up[0] - f[0] * up[2], f[0] * up[1] - f[1] * up[0]]
    length = F.sqrt(r[0] * r[0] + r[1] * r[1] + r[2] * r[2])
    r = [c / length for c in r]
    d = [f[1] * r[2] - f[2] * r[1], f[2] * r[0] - f[0] * r[2], f[0] * r[1] - f[1] * r[0]]
    rows = []
    for axis in (r, d, f):
        rows += [*axis, -(axis[0] * eye[0] + axis[1] * eye[1] + axis[2] * eye[2])]
    return F.array(*rows)


def inverse_rigid(m: Column) -> Column:
    """The inverse of a rigid 4 x 4 matrix given as array<array<double>>: transposed rotation, turned translation."""
    at = lambda i, j: F.get(F.get(m, i), j)
    rows = []
    for i in range(3):
        t = -(at(0, i) * at(0, 3) + at(1, i) * at(1, 3) + at(2, i) * at(2, 3))
        rows.append(F.array(at(0, i), at(1, i), at(2, i), t))
    return F.array(*rows, F.array(*[F.lit(float(x)) for x in (0, 0, 0, 1)]))


def projection(fov: Column, near: float, far: float) -> Column:
    f = 1 / F.tan(fov / 2)
    zero, one = F.lit(0.0), F.lit(1.0)
    return F.array(f, zero, zero, zero, zero, f, zero, zero, zero, zero, F.lit(far / (far - near)), F.lit(-far * near / (far - near)), zero, zero, one, zero)


def rotary_phases(coord: Column, freqs: int, base: float = 10000.0) -> Column:
    """array<struct<cos, sin>> of coord * base ** (-i / freqs)."""
    steps = F.array(*[F.lit(base ** (-i / freqs)) for i in range(freqs)])
    return F.transform(steps, lambda f: F.struct(F.cos(coord * f).alias("cos"), F.sin(coord * f).alias("sin")))


def rotary(x: Column, y: Column, z: Column, dim: int) -> Column:
    """Phases of three axes, filled up with (1, 0) to dim pairs."""
    per = dim // 3
    fill = F.array_repeat(F.struct(F.lit(1.0).alias("cos"), F.lit(0.0).alias("sin")), dim - 3 * per)
    return F.concat(*[rotary_phases(c, per) for c in (x, y, z)], fill)


def timestep_embedding(t: Column, dim: int, longest: float = 10000.0) -> Column:
    """cos then sin of t * longest ** (-i / (dim / 2)); an odd dim ends in 0."""
    half = dim // 2
    freqs = F.array(*[F.lit(longest ** (-i / half)) for i in range(half)])
    out = F.concat(F.transform(freqs, lambda f: F.cos(t * f)), F.transform(freqs, lambda f: F.sin(t * f)))
    return F.concat(out, F.array(F.lit(0.0))) if dim % 2 else out


# --- flow paths -----------------------------------------------------------------------------------------------------


def diffuse(x0: Column, noise: Column, t: Column, sigma_min: float = 1e-5) -> Column:
    return F.zip_with(x0, noise, lambda a, e: (1 - t) * a + (sigma_min + (1 - sigma_min) * t) * e)


def velocity(x0: Column, noise: Column, sigma_min: float = 1e-5) -> Column:
    return F.zip_with(x0, noise, lambda a, e: (1 - sigma_min) * e - a)


def velocity_to_x0(xt: Column, v: Column, t: Column, sigma_min: float = 1e-5) -> Column:
    return F.zip_with(xt, v, lambda x, u: (1 - sigma_min) * x - (sigma_min + (1 - sigma_min) * t) * u)


def velocity_to_noise(xt: Column, v: Column, t: Column) -> Column:
    return F.zip_with(xt, v, lambda x, u: (1 - t) * u + x)


def euler_step(xt: Column, v: Column, t: Column, before: Column) -> Column:
    return F.zip_with(xt, v, lambda x, u: x - (t - before) * u)


def rescale_time(t: Column, r: float) -> Column:
    return t * r / (1 + (r - 1) * t)


def logit_normal(z: Column, mean: float = 0.0, std: float = 1.0) -> Column:
    return 1 / (1 + F.exp(-(z * std + mean)))


def guide(pos: Column, neg: Column, strength: float) -> Column:
    return F.zip_with(pos, neg, lambda p, n: p * strength + n * (1 - strength))


def std_rescale(guided: Column, pos: Column, share: float) -> Column:
    """guided mixed with itself scaled to the standard deviation of pos."""

    def std(a: Column) -> Column:
        n = F.size(a)
        mean = F.aggregate(a, F.lit(0.0), lambda s, v: s + v) / n
        return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, v: s + (v - mean) * (v - mean)) / n)

    factor = F.try_divide(std(pos), std(guided))
    return F.transform(guided, lambda g: g * factor * share + g * (1 - share))


def in_interval(t: Column, low: float, high: float) -> Column:
    return t.between(low, high)


def drop_condition(cond: Column, neg: Column, p: float, *parts: Column) -> Column:
    return F.when(hash_uniform(*parts) < p, neg).otherwise(cond)


def tone_map(c: Column) -> Column:
    """The rational filmic curve, held in [0, 1]."""
    return clip((c * (c * 2.51 + 0.03)) / (c * (c * 2.43 + 0.59) + 0.14), 0.0, 1.0)


def gamma(c: Column, g: float = 2.2) -> Column:
    return F.pow(clip(c, 0.0, 1.0), F.lit(1 / g))


def warm_up(step: Column, steps: int) -> Column:
    return F.least((step + 1) / steps, F.lit(1.0))


def abs_error(x: Column, y: Column) -> Column:
    return F.abs(x - y)


def rel_error(x: Column, y: Column) -> Column:
    return F.abs(x - y) / F.greatest(F.abs(x), F.abs(y), F.lit(1e-12))


# --- strings, hashes, JSON ------------------------------------------------------------------------------------------


def relative_path(path: Column, root: str) -> Column:
    root = root.rstrip("/") + "/"
    return F.when(path.startswith(root), F.substring(path, len(root) + 1, 1 << 30)).otherwise(path)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def zip_member(path: Column, depth: int = 5) -> Column:
    """struct<archive, member>: a path split after its first `depth` parts."""
    parts = F.split(path, "/")
    return F.struct(F.concat_ws("/", F.slice(parts, 1, depth)).alias("archive"), F.concat_ws("/", F.slice(parts, F.lit(depth + 1), F.greatest(F.size(parts) - depth, F.lit(0)))).alias("member"))


def python_dict_value(text: Column, key: str) -> Column:
    """One value of a Python dict literal in a text column; null where it can't be read."""
    json = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"\bNone\b", "null"), r"\bTrue\b", "true"), r"\bFalse\b", "false")
    return F.get_json_object(F.regexp_replace(json, "'", '"'), f"$.{key}")


def content_sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def murmur_finaliser(k: Column) -> Column:
    """The 32-bit finaliser, in long arithmetic."""
    mask = F.lit(0xFFFFFFFF).cast("long")

    def low(c: Column) -> Column:
        return c.bitwiseAND(mask)

    def times(c: Column, m: int) -> Column:  # 32 x 32 bits in two halves, so that a long holds each product
        a, b = F.shiftright(c, 16), c.bitwiseAND(F.lit(0xFFFF).cast("long"))
        return low(F.call_function("shiftleft", low(a * m).bitwiseAND(F.lit(0xFFFF).cast("long")), F.lit(16)) + b * m)

    k = low(k.cast("long"))
    k = times(k.bitwiseXOR(F.shiftright(k, 16)), 0x85EBCA6B)
    k = times(k.bitwiseXOR(F.shiftright(k, 13)), 0xC2B2AE35)
    return k.bitwiseXOR(F.shiftright(k, 16))


def spatial_hash(x: Column, y: Column, z: Column, slots: int) -> Column:
    p = [c.cast("long") * m for c, m in ((x, 73856093), (y, 19349663), (z, 83492791))]
    return F.pmod(p[0].bitwiseXOR(p[1]).bitwiseXOR(p[2]), F.lit(slots))


def pca_colour(df, feats: str, by: Sequence[str] = (), k: int = 3):
    """df with `colour`: the first k principal components, each scaled to 0 ... 1 (over the groups `by`)."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = df.withColumn("__v", array_to_vector(F.col(feats).cast("array<double>")))
    rows = PCA(k=k, inputCol="__v", outputCol="__p").fit(rows).transform(rows).withColumn("__a", vector_to_array("__p"))
    one = lambda i: F.get("__a", F.lit(i))
    stats = rows.groupBy(*by).agg(*[f(one(i)).alias(f"__{n}{i}") for i in range(k) for n, f in (("lo", F.min), ("hi", F.max))])
    rows = rows.join(stats, list(by)) if by else rows.crossJoin(F.broadcast(stats))  # without groups, stats has one row
    colour = [F.try_divide(one(i) - F.col(f"__lo{i}"), F.col(f"__hi{i}") - F.col(f"__lo{i}")) for i in range(k)]
    return rows.withColumn("colour", F.array(*colour)).select(*df.columns, "colour")


def round_signed(x: Column, digits: int) -> Column:
    """x to so many decimals, halves away from zero, as DuckDB rounds doubles: what is negative and rounds to zero is -0.0."""
    return F.signum(x) * F.round(F.abs(x) * 10.0**digits) / 10.0**digits
