"""What the operators of this subpackage share: reading tables, Arrow batches, samples; checkpoint is the session's."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lattica.session import checkpoint, ship

__all__ = ["WORD", "checkpoint", "crc_mod", "fresh", "hash_sample", "let", "one_text", "read_table", "running", "small_batches", "text_slices"]

#: Rows in one Arrow batch handed to Python; texts can be long, so fewer than Spark's 10,000.
ARROW_ROWS = 1000
#: Bytes of text that a kernel works on at once.
CHUNK_BYTES = 1 << 20
#: The words of every contract: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Make ready for Python workers: they get the package, and smaller Arrow batches unless the session has chosen."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(ARROW_ROWS))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that df doesn't have (case-insensitively), one for each name given."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        x = name
        while x.lower() in taken:
            x = f"_{x}"
        taken.add(x.lower())
        out.append(x)
    return out


def text_slices(batches: Iterator[pa.RecordBatch], column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut by rows, so that each piece holds about `most` bytes of text (a longer row stands alone)."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        lengths = pc.binary_length(batch.column(at)).fill_null(0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, n in enumerate(lengths.tolist()):
            if total and total + n > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < batch.num_rows:
            yield batch.slice(start)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once: as a lambda's argument it isn't computed again in every lambda that uses it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


#: Items folded in one go by `running`.
RUN = 128


def running(values: Column, kind: str, op: Callable[[Column, Column], Column], zero: Column) -> Column:
    """The fold of all earlier items, for each item of an array. Items are folded in blocks of RUN and the blocks' results once
    more, so that only short arrays are copied while they grow."""

    def fold(items: Column) -> Column:
        start = F.struct(zero.alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
        return F.aggregate(items, start, lambda acc, x: F.struct(op(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))

    def joined(blocks: Column) -> Column:
        before = fold(F.transform(blocks, lambda b: b["at"]))["out"]
        return let(before, lambda ahead: F.flatten(F.transform(blocks, lambda b, i: F.transform(b["out"], lambda x: op(F.get(ahead, i), x)))))

    def cut(items: Column) -> Column:
        starts = F.when(F.size(items) > 0, F.sequence(F.lit(1), F.size(items), F.lit(RUN))).otherwise(F.array().cast("array<int>"))
        return let(F.transform(starts, lambda s: fold(F.slice(items, s, F.lit(RUN)))), joined)

    return let(values, cut)


def hash_sample(rows: DataFrame, group: str, key: str, n: int) -> DataFrame:
    """Up to n distinct keys of each group, those with the smallest hashes: (group, key). Copies of a row are one key. A
    threshold from the group's number of distinct keys (an estimate, with room to spare) lets about 2 n of them through to the
    ranking, so no task gathers a group. The table of thresholds has a row per group; groups are labels or languages."""
    share = F.shiftrightunsigned(F.xxhash64(key), 24) / float(1 << 40)
    rows = rows.where(F.col(key).isNotNull())
    most = rows.groupBy(group).agg((F.lit(2.0 * n + 60) / F.approx_count_distinct(key)).alias("__share"))
    near = rows.join(F.broadcast(most), group).where(share < F.col("__share")).select(group, key).distinct()
    nth = F.row_number().over(W.partitionBy(group).orderBy(F.shiftrightunsigned(F.xxhash64(key), 24), key))
    return near.withColumn("__nth", nth).where(F.col("__nth") <= n).select(group, key)


def one_text(docs: DataFrame, chosen: DataFrame, group: str, key: str, text: str) -> DataFrame:
    """(group, key, text) of a bounded sample of keys: copies of a row, and rows that share a key, are one document, that with
    the text that sorts first; map-side, so that copies aren't shuffled."""
    return docs.join(F.broadcast(chosen), [key, group] if group in docs.columns else key).groupBy(group, key).agg(F.min(text).alias(text))


def crc_mod(column: str, n: int):
    """crc32 of the value as text, modulo n; null stays null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n
