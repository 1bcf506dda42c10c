"""Deterministic, resumable and load-balanced sampling."""

from __future__ import annotations

from collections.abc import Sequence
from heapq import heapify, heappop, heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.operators.catalog import global_index, shard_of
from lattica.session import ship


def shuffle_key(key: str, seed: int, epoch: int) -> Column:
    """Sorts an epoch's permutation; md5, so that other engines can check it."""
    return F.md5(F.concat_ws(":", F.lit(str(seed + epoch)), F.col(key).cast("string")))


def epoch_order(df: DataFrame, key: str, seed: int, epoch: int, name: str = "i") -> DataFrame:
    return global_index(df.withColumn("__h", shuffle_key(key, seed, epoch)), "__h", key, name=name).drop("__h")


def even_total(df: DataFrame, world: int, i: str = "i", drop_last: bool = False, n: int | None = None) -> DataFrame:
    """Rows repeated from the start, or cut from the end, to a multiple of the world size. n: the rows, if they are counted."""
    n = df.count() if n is None else n
    total = n // world * world if drop_last else -(-n // world) * world
    if drop_last or total == n or n == 0:
        return df.where(F.col(i) < total)
    return df.unionByName(df.where(F.col(i) < total - n).withColumn(i, F.col(i) + n)) if total - n <= n else _cycled(df, n, total, i)


def _cycled(df: DataFrame, n: int, total: int, i: str) -> DataFrame:
    rounds = F.sequence(F.lit(0), F.lit(-(-total // n) - 1))
    return df.withColumn("__k", F.explode(rounds)).withColumn(i, F.col(i) + F.col("__k") * n).where(F.col(i) < total).drop("__k")


def rank_slice(df: DataFrame, world: int, rank: int, resume: int = 0, i: str = "i") -> DataFrame:
    """Every world-th row from `rank`, without the first `resume` of them."""
    return df.where((F.pmod(i, F.lit(world)) == rank) & (F.floor(F.col(i) / world) >= resume))


def least_loaded(load: Sequence[float], groups: int, equal: bool = False) -> np.ndarray:
    """Group of each item: heaviest first (ties: the later item first), each into the least loaded group (ties: the first).
    With equal, a group leaves the heap once it holds its share, len // groups items; items beyond all shares open every group
    for one more."""
    out = np.empty(len(load), np.int32)
    heaviest = sorted(range(len(load)), key=lambda x: (load[x], x), reverse=True)
    share = len(load) // groups if equal else len(load)
    free, full = [(0.0, g, 0) for g in range(groups)], []
    for x in heaviest:
        if not free or (equal and share == 0):
            free, full, share = [*free, *full], [], share + 1
            heapify(free)
        total, g, held = free[0]
        out[x] = g
        now = (total + load[x], g, held + 1)
        if equal and held + 1 >= share:
            heappop(free)
            full.append(now)
        else:
            heapreplace(free, now)
    return out


def balanced_groups(df: DataFrame, batch: str, order: str, load: str, groups: int, equal: bool = False, name: str = "group") -> DataFrame:
    """df with the group of each row inside its batch; batches are bounded by their size and dealt in parallel."""
    ship(df.sparkSession)
    fields = df.schema.fields

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(order)
        return rows.append_column(name, pa.array(least_loaded(rows.column(load).to_pylist(), groups, equal), pa.int32()))

    return df.groupBy(batch).applyInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + f", {name} int")


def balanced_sampler(df: DataFrame, key: str, load: str, seed: int, epoch: int, world: int, batch_size: int, drop_last: bool = False) -> DataFrame:
    """Macro-batches of batch_size * world rows of the epoch's order, balanced over ranks; an incomplete one is dropped.
    Adds i (place in the epoch), macro and rank."""
    macro, n = batch_size * world, df.count()
    total = n // world * world if drop_last else -(-n // world) * world
    rows = even_total(epoch_order(df, key, seed, epoch), world, drop_last=drop_last, n=n)
    rows = rows.where(F.col("i") < total // macro * macro).withColumn("macro", F.floor(F.col("i") / macro))
    return balanced_groups(rows, "macro", "i", load, world, True, "rank")


def micro_batches(df: DataFrame, batch: str, order: str, load: str, split: int) -> DataFrame:
    return balanced_groups(df, batch, order, load, split, name="micro")


def even_split(df: DataFrame, i: str, n: Column, parts: int, name: str = "part") -> DataFrame:
    return df.withColumn(name, shard_of(F.col(i), n, parts))


def pick_views(df: DataFrame, key: str, views: int, most: int, seed: int = 0) -> DataFrame:
    """k distinct views of each row, k even in 1 ... most, both from hashes."""
    h = lambda *x: F.conv(F.substring(F.md5(F.concat_ws(":", *x)), 1, 8), 16, 10).cast("long")
    k = F.pmod(h(F.lit(str(seed)), F.lit("k"), F.col(key).cast("string")), F.lit(most)) + 1
    ranked = F.array_sort(
        F.transform(F.sequence(F.lit(0), F.lit(views - 1)), lambda v: F.struct(h(F.lit(str(seed)), v.cast("string"), F.col(key).cast("string")).alias("h"), v.alias("v")))
    )
    return df.withColumn("view", F.explode(F.transform(F.slice(ranked, F.lit(1), k.cast("int")), lambda s: s["v"])))


class SamplerState:
    """(epoch, idx) of a sampler, advanced step by step and kept as a one-row table."""

    def __init__(self, length: int, epoch: int = 0, idx: int = 0):
        self.length, self.epoch, self.idx = length, epoch, idx

    def advance(self, rows: int) -> SamplerState:
        """Past so many rows; a new epoch starts at its first row."""
        done = self.idx + rows
        return SamplerState(self.length, self.epoch + done // self.length, done % self.length)

    def save(self, spark: SparkSession, path: str) -> None:
        spark.range(1).select(F.lit(self.epoch).cast("long").alias("epoch"), F.lit(self.idx).cast("long").alias("idx")).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, length: int) -> SamplerState:
        row = spark.read.parquet(path).first()
        return cls(length, row["epoch"], row["idx"])
