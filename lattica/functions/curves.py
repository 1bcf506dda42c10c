"""Space-filling curves over 10-bit coordinates as column expressions: codes stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 10

# Multipliers and masks that spread 10 bits to every third place, and shifts and masks that gather them.
SPREAD = ((0x00010001, 0xFF0000FF), (0x00000101, 0x0F00F00F), (0x00000011, 0xC30C30C3), (0x00000005, 0x49249249))
GATHER = ((2, 0x030C30C3), (4, 0x0300F00F), (8, 0x030000FF), (16, 0x000003FF))


def _long(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")


def spread(v: Column) -> Column:
    """The 10 bits of v at every third place of 30."""
    for factor, mask in SPREAD:
        v = (v * F.lit(factor).cast("long")).bitwiseAND(F.lit(mask).cast("long"))
    return v


def gather(v: Column) -> Column:
    """The inverse of spread; other bits are ignored."""
    v = v.bitwiseAND(F.lit(0x49249249).cast("long"))
    for shift, mask in GATHER:
        v = v.bitwiseXOR(F.shiftright(v, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return v


def z_order(x: Column | str, y: Column | str, z: Column | str, axes: Sequence[int] = (0, 1, 2)) -> Column:
    """Morton code; the first of the permuted axes takes the high bit of each triple."""
    c = [_long(v) for v in (x, y, z)]
    a, b, d = (spread(c[i]) for i in axes)
    return a * 4 + b * 2 + d


def z_order_decode(code: Column | str, axes: Sequence[int] = (0, 1, 2)) -> Column:
    """struct<x, y, z> of a Morton code."""
    code = _long(code)
    got = [gather(F.shiftright(code, 2)), gather(F.shiftright(code, 1)), gather(code)]
    return F.struct(*[got[list(axes).index(i)].cast("int").alias(n) for i, n in enumerate("xyz")])


def _steps(point: Column, bits: Sequence[int], order: Sequence[int]) -> Column:
    """Skilling's exchange over an array<long> of three coordinates: for every bit and axis, invert the low bits of the
    first coordinate where the axis has the bit, else swap them with the first's."""

    def step(p: Column, q: Column) -> Column:
        low = q - 1
        x = [p[0], p[1], p[2]]
        for i in order:
            has = x[i].bitwiseAND(q) != 0
            t = x[0].bitwiseXOR(x[i]).bitwiseAND(low)
            first = F.when(has, x[0].bitwiseXOR(low)).otherwise(x[0].bitwiseXOR(t))
            other = F.when(has, x[i]).otherwise(x[i].bitwiseXOR(t))
            if i == 0:  # the swap with itself does nothing
                x[0] = F.when(has, x[0].bitwiseXOR(low)).otherwise(x[0])
            else:
                x[0], x[i] = first, other
        return F.array(*x)

    return F.aggregate(F.array(*[F.lit(b).cast("long") for b in bits]), point, step)


def hilbert(x: Column | str, y: Column | str, z: Column | str) -> Column:
    """Place on the 10-bit Hilbert curve."""
    bits = [1 << b for b in range(BITS - 1, 0, -1)]
    p = _steps(F.array(_long(x), _long(y), _long(z)), bits, (0, 1, 2))

    def gray(p: Column) -> Column:
        a = p[0]
        b = p[1].bitwiseXOR(a)
        c = p[2].bitwiseXOR(b)
        t = F.aggregate(
            F.array(*[F.lit(q).cast("long") for q in bits]),
            F.lit(0).cast("long"),
            lambda t, q: F.when(c.bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t),
        )
        return spread(a.bitwiseXOR(t)) * 4 + spread(b.bitwiseXOR(t)) * 2 + spread(c.bitwiseXOR(t))

    return F.transform(F.array(p), gray)[0]


def hilbert_decode(code: Column | str) -> Column:
    """struct<x, y, z> of a place on the curve."""
    code = _long(code)
    a, b, c = gather(F.shiftright(code, 2)), gather(F.shiftright(code, 1)), gather(code)
    start = F.array(a.bitwiseXOR(F.shiftright(c, 1)), b.bitwiseXOR(a), c.bitwiseXOR(b))
    p = _steps(start, [1 << b for b in range(1, BITS)], (2, 1, 0))
    return F.transform(F.array(p), lambda p: F.struct(*[p[i].cast("int").alias(n) for i, n in enumerate("xyz")]))[0]


def flat_index(b: Column | str, x: Column | str, y: Column | str, z: Column | str, shape: tuple[int, int, int]) -> Column:
    """((b W + x) H + y) D + z, as a long."""
    w, h, d = shape
    return ((_long(b) * w + _long(x)) * h + _long(y)) * d + _long(z)


def flat_index_decode(index: Column | str, shape: tuple[int, int, int]) -> Column:
    w, h, d = shape
    i = _long(index)
    hd, whd = h * d, w * h * d
    return F.struct(
        F.floor(i / whd).cast("int").alias("b"), F.floor(F.pmod(i, F.lit(whd)) / hd).cast("int").alias("x"),
        F.floor(F.pmod(i, F.lit(hd)) / d).cast("int").alias("y"), F.pmod(i, F.lit(d)).cast("int").alias("z"),
    )


def covering_ranges(low: tuple[int, int, int], high: tuple[int, int, int], level: int) -> list[tuple[int, int]]:
    """Morton ranges [a, b] that cover the box low..high (inclusive), from the cubes of side 2**level that touch it,
    neighbouring ranges merged. The level bounds how many there are."""
    side = 1 << level

    def code(x: int, y: int, z: int) -> int:
        return sum(((v >> i) & 1) << (3 * i + s) for v, s in ((x, 2), (y, 1), (z, 0)) for i in range(BITS))

    cubes = sorted(
        code(x, y, z)
        for x in range(low[0] // side * side, high[0] + 1, side)
        for y in range(low[1] // side * side, high[1] + 1, side)
        for z in range(low[2] // side * side, high[2] + 1, side)
    )
    out: list[tuple[int, int]] = []
    for c in cubes:
        if out and out[-1][1] + 1 == c:
            out[-1] = (out[-1][0], c + side**3 - 1)
        else:
            out.append((c, c + side**3 - 1))
    return out


def in_box(code: Column | str, low: tuple[int, int, int], high: tuple[int, int, int], level: int = 6) -> Column:
    """A predicate on a stored code column that a scan can use to skip row groups; test the exact box besides."""
    c = F.col(code) if isinstance(code, str) else code
    out = F.lit(False)
    for a, b in covering_ranges(low, high, level):
        out = out | c.between(a, b)
    return out


def clustered(df, code: Column | str, partitions: int | None = None):
    """df range-partitioned and sorted by a curve code, so that files hold compact regions."""
    args = [partitions] if partitions else []
    c = F.col(code) if isinstance(code, str) else code
    return df.repartitionByRange(*args, c).sortWithinPartitions(c)
