"""Data sets over catalogs: named predicates, added columns, loaded instances. A mixin is a function from data set to data set."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattica.functions.udfs import foreach_row, split_errors
from lattica.operators import catalog, sampling
from lattica.session import checkpoint

Predicate = Callable[[DataFrame], Column]
Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Dataset:
    """Instances are rows (root, key) of one or more catalogs that pass all predicates; a null predicate fails."""

    key: str = "sha256"
    steps: tuple[tuple[str, Predicate], ...] = ()
    added: tuple[Step, ...] = ()

    def where(self, name: str, predicate: Predicate) -> Dataset:
        return replace(self, steps=(*self.steps, (name, predicate)))

    def adding(self, step: Step) -> Dataset:
        return replace(self, added=(*self.added, step))

    def _one(self, root: str, source: DataFrame) -> DataFrame:
        rows = reduce(lambda df, s: df.where(s[1](source)), self.steps, source)
        return reduce(lambda df, f: f(df), self.added, rows).withColumn("root", F.lit(root))

    def instances(self, sources: Mapping[str, DataFrame]) -> DataFrame:
        """The rows of all sources with their root; columns that a source lacks are null."""
        return _united([self._one(root, df) for root, df in sources.items()])

    def stats(self, sources: Mapping[str, DataFrame]) -> DataFrame:
        """(root, step, name, survivors): a source's rows left after each predicate, one pass over each."""
        return _united([catalog.funnel(df, [(n, p(df)) for n, p in self.steps]).withColumn("root", F.lit(root)) for root, df in sources.items()])

    def load(self, sources: Mapping[str, DataFrame], func: Callable[[dict], dict | None], schema: str) -> DataFrame:
        """(root, key, fields of schema, error): func on every instance, errors kept with their rows."""
        return _united([foreach_row(self._one(root, df), func, schema, self.key).withColumn("root", F.lit(root)) for root, df in sources.items()])


def _united(tables: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def replace_failed(loaded: DataFrame, key: str = "sha256", seed: int = 0) -> DataFrame:
    """(root, key, fields, from_root, from_key): a failed instance's place takes an instance that loaded, picked by a hash of the
    place; without any, failed places are left out. Loaded rows are kept once, so func isn't run again; only keys are numbered."""
    good, bad = split_errors(checkpoint(loaded))
    numbered = catalog.global_index(good.select(F.col("root").alias("from_root"), F.col(key).alias("from_key")), "from_root", "from_key", name="__i")
    n = good.agg(F.nullif(F.count("*"), F.lit(0)).alias("__n"))
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), "root", F.col(key).cast("string"))), 1, 8), 16, 10).cast("long")
    asked = bad.select("root", key, h.alias("__h")).crossJoin(F.broadcast(n))  # n: one row
    picked = asked.withColumn("__i", F.pmod("__h", "__n")).join(numbered, "__i").select("root", key, "from_root", "from_key")
    values = good.withColumnsRenamed({"root": "from_root", key: "from_key"})
    kept = good.select("*", F.col("root").alias("from_root"), F.col(key).alias("from_key"))
    return kept.unionByName(picked.join(values, ["from_root", "from_key"]))


def image_conditioned(data: Dataset, views: int, most: int = 1) -> Dataset:
    """Only assets with rendered conditions, each with a view; most > 1: with 1 ... most distinct views, a row each."""
    rendered = data.where("Cond rendered", lambda df: ~catalog.missing(df, "cond_rendered"))
    return rendered.adding(lambda df: sampling.pick_views(df, data.key, views, most))
