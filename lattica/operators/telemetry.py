"""Metric reduction and state over ordered steps.

Rolling windows and moving averages are defined over one ordered sequence each (a run); `by` names the run, and runs are
computed in parallel. A run's steps are bounded by the run, not by the number of runs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten_names(schema: T.StructType, prefix: str = "", sep: str = "/") -> dict[str, str]:
    """Leaf name -> column path of a nested schema."""
    out = {}
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        if isinstance(f.dataType, T.StructType):
            out |= flatten_names(f.dataType, f"{path}.", sep)
        else:
            out[path.replace(".", sep)] = path
    return out


def flatten(df: DataFrame, sep: str = "/") -> DataFrame:
    return df.select(*[F.col(path).alias(name) for name, path in flatten_names(df.schema, sep=sep).items()])


def map_leaves(df: DataFrame, column: str, special: dict[str, Callable[[Column], Column]], default: Callable[[Column], Column]) -> DataFrame:
    """A map column with each value changed by the function of its key's last part, or the default."""

    def change(k: Column, v: Column) -> Column:
        leaf = F.element_at(F.split(k, "/"), -1)
        out = default(v)
        for name, f in special.items():
            out = F.when(leaf == name, f(v)).otherwise(out)
        return out

    return df.withColumn(column, F.transform_values(column, change))


def reduce_metrics(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., key, value, n) over a map column: the mean of each leaf over the rows that have it; the least or greatest for
    leaves whose name ends in min or max."""
    rows = df.select(*by, F.explode(column).alias("key", "v"))
    leaf = F.element_at(F.split("key", "/"), -1)
    got = rows.groupBy(*by, "key").agg(F.avg("v").alias("mean"), F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("n"))
    value = F.when(leaf.endswith("min"), F.col("low")).when(leaf.endswith("max"), F.col("high")).otherwise(F.col("mean"))
    return got.select(*by, "key", value.alias("value"), "n")


def merge_disjoint(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Rows of both; a key with a value on both sides is an error."""
    j = a.join(b.withColumnRenamed(value, "__o"), key, "full")
    clash = F.col(value).isNotNull() & F.col("__o").isNotNull()
    return j.select(key, F.when(clash, F.raise_error(F.concat(F.lit("duplicate key "), F.col(key).cast("string")))).otherwise(F.coalesce(value, "__o")).alias(value))


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


def rolling_percentile(df: DataFrame, value: str, order: Sequence[str], size: int, q: float, cap: float | None = None, by: Sequence[str] = ()) -> DataFrame:
    """df's finite rows with `clip`: the q-quantile (linear) of the last `size` values, once there are that many; not above cap."""
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(-(size - 1), 0)
    rows = df.where(finite(F.col(value)))
    p = F.percentile(value, F.lit(q)).over(w)
    clip = F.when(F.count(value).over(w) == size, p if cap is None else F.least(p, F.lit(cap)))
    return rows.withColumn("clip", clip)


def rolling_regression(df: DataFrame, x: str, y: str, order: Sequence[str], size: int, every: int, by: Sequence[str] = ()) -> DataFrame:
    """Every `every`-th row with slope and intercept of y over x on the last `size` rows."""
    at = W.partitionBy(*by).orderBy(*order)
    w = at.rowsBetween(-(size - 1), 0)
    rows = df.select("*", F.regr_slope(y, x).over(w).alias("slope"), F.regr_intercept(y, x).over(w).alias("intercept"), F.row_number().over(at).alias("step"))
    return rows.where(F.col("step") % every == 0)


def memory_ratio(target: float, slope: Column, intercept: Column, size: Column) -> Column:
    return F.least(F.greatest(F.try_divide(F.lit(target) - intercept, slope * size), F.lit(0.0)), F.lit(1.0))


def ema(df: DataFrame, value: str, order: Sequence[str], rate: float, by: Sequence[str] = ()) -> DataFrame:
    """(by..., ema): e = rate e + (1 - rate) x over the ordered values, from the first one."""
    got = df.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("v")))).alias("s"))
    step = lambda e, s: F.when(e.isNull(), s["v"]).otherwise(e * rate + s["v"] * (1 - rate))
    return got.select(*by, F.aggregate("s", F.lit(None).cast("double"), step).alias("ema"))


def progress(df: DataFrame, ts: str, order: Sequence[str], total: int, by: Sequence[str] = ()) -> DataFrame:
    """df with done, avg (seconds per item) and eta (seconds) after each row; ts in seconds."""
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    done, spent = F.count("*").over(w), F.max(ts).over(w) - F.min(ts).over(w)
    return df.select("*", done.alias("done"), (spent / done).alias("avg"), (spent / done * (F.lit(total) - done)).alias("eta"))


def time_bins(df: DataFrame, t: str, value: str, bins: int = 10) -> DataFrame:
    """(bin, mean, n) over [0, 1) cut evenly; empty bins don't occur."""
    b = F.least(F.floor(F.col(t) * bins), F.lit(bins - 1)).cast("int")
    return df.where((F.col(t) >= 0) & (F.col(t) < 1)).groupBy(b.alias("bin")).agg(F.avg(value).alias("mean"), F.count("*").alias("n"))


def all_of(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.explode(column).alias("k", "v")).agg(F.coalesce(F.bool_and("v"), F.lit(True)).alias("all"), F.coalesce(F.bool_or("v"), F.lit(False)).alias("any"))


# --- losses ---------------------------------------------------------------------------------------------------------


def l1(x: Column, y: Column) -> Column:
    return F.avg(F.abs(x - y))


def l2(x: Column, y: Column) -> Column:
    return F.avg((x - y) * (x - y))


def smooth_l1(x: Column, y: Column, beta: float = 1.0) -> Column:
    d = F.abs(x - y)
    return F.avg(F.when(d < beta, d * d * 0.5 / beta).otherwise(d - 0.5 * beta))


def psnr(x: Column, y: Column, peak: float = 1.0) -> Column:
    return 20 * F.log10(F.lit(peak) / F.sqrt(l2(x, y)))


def kl(mean: Column, logvar: Column) -> Column:
    return F.avg((mean * mean + F.exp(logvar) - logvar - 1) * 0.5)


def bce_logits(x: Column, y: Column) -> Column:
    """The stable form: max(x, 0) - x y + log(1 + exp(-|x|))."""
    return F.avg(F.greatest(x, F.lit(0.0)) - x * y + F.log1p(F.exp(-F.abs(x))))


def dice(p: Column, y: Column, smooth: float = 1.0) -> Column:
    return 1 - (F.sum(p * y) * 2 + smooth) / (F.sum(p) + F.sum(y) + smooth)


def normal_angle(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Mean angle in degrees between unit normals."""
    d = a[0] * b[0] + a[1] * b[1] + a[2] * b[2]
    return F.avg(F.degrees(F.acos(F.greatest(F.least(d, F.lit(1.0)), F.lit(-1.0)))))


def ssim(pixels: DataFrame, a: str, b: str, by: Sequence[str] = (), size: int = 11, sigma: float = 1.5, c1: float = 0.01**2, c2: float = 0.03**2) -> DataFrame:
    """Structural similarity of two pixel columns at (px, py): Gaussian-weighted local moments from one exploded
    aggregation (every pixel adds to the size**2 windows around it), then their mean."""
    from math import exp

    r = size // 2
    g = [exp(-(i - r) ** 2 / (2 * sigma**2)) for i in range(size)]
    total = sum(g)
    shifts = F.array(*[
        F.struct(F.lit(i - r).alias("dx"), F.lit(j - r).alias("dy"), F.lit(g[i] * g[j] / total**2).alias("w")) for i in range(size) for j in range(size)
    ])
    x, y, w = F.col(a), F.col(b), F.col("s.w")
    spread = pixels.select(*by, "px", "py", a, b, F.explode(shifts).alias("s"))
    moments = spread.groupBy(*by, (F.col("px") + F.col("s.dx")).alias("px"), (F.col("py") + F.col("s.dy")).alias("py")).agg(
        F.sum(w * x).alias("mx"), F.sum(w * y).alias("my"), F.sum(w * x * x).alias("xx"), F.sum(w * y * y).alias("yy"), F.sum(w * x * y).alias("xy")
    )
    moments = moments.join(pixels.select(*by, "px", "py"), [*by, "px", "py"], "left_semi")
    mx, my = F.col("mx"), F.col("my")
    vx, vy, cov = F.col("xx") - mx * mx, F.col("yy") - my * my, F.col("xy") - mx * my
    value = ((mx * my * 2 + c1) * (cov * 2 + c2)) / ((mx * mx + my * my + c1) * (vx + vy + c2))
    return moments.groupBy(*by).agg(F.avg(value).alias("ssim"))
