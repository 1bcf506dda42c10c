"""Mixing sources to target weights along a time-varying curriculum.

A document's size is its number of words. Sources, in code-point order with null last, take the weights in turn; a source's
target is its share by weight of all words, but never more than `cap` times its own size: what lies above is shared out
again by weight until no source is above. (Sorting sources by capacity over weight gives that fixed point in one pass.)

Each source is a stream of its documents in an order drawn from md5(seed, doc_id). The target says how often the stream is
passed: whole passes, then the documents whose middle lies below the remainder. A source's demand over training time
t in [0, 1] follows its weight schedule w(t) = 1 + a (2t - 1); its integral t + a (t^2 - t) is the cumulative share of the
target asked for by time t, and inverting it gives every copy of a document the time at which its middle is asked for. Copies
are then range-sorted by that time: its unit interval is cut into as many parts as there are shuffle partitions, each is sorted
by itself, and a copy's rank is its place in its part behind the counts of the parts before.

Offsets within a source are two-level prefix sums: over BUCKETS hash buckets of (source, bucket) totals, then inside a
bucket, so that one source with a third of all rows is spread over thousands of windows.

Defined results: a null text has size 0 and is taken 0 times in words; a null source is a source of its own and sorts last;
a source without words has target 0; an empty table gives an empty result; repeated rows are rows of their own, and rows
equal in doc_id and size share their order without effect on any figure. Clashing column names in the input are kept apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lattica.llm.common import WORD, checkpoint, fresh

WEIGHTS = (5.0, 2.0, 1.0)
#: Schedule slope of each source, taken in turn like the weights: from early to late in training.
SLOPES = (-0.5, 0.0, 0.5)
CAP = 3.0
#: Hash buckets of a source: three hex digits of the md5.
BUCKETS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def order_hash(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def targets(totals: DataFrame, weights: tuple[float, ...] = WEIGHTS, slopes: tuple[float, ...] = SLOPES, cap: float = CAP) -> DataFrame:
    """(key, source_size, target, slope) from one row (key, source, source_size) per source."""
    place = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1).cast("int")
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (F.pmod("place", F.lit(len(values))) + 1).cast("int"))
    rows = totals.withColumn("place", place).select("key", "source_size", pick(weights).alias("weight"), pick(slopes).alias("slope"))
    rows = rows.withColumn("most", F.col("source_size") * F.lit(cap)).withColumn("ratio", F.col("most") / F.col("weight"))
    order = W.orderBy("ratio", "key")
    every = W.partitionBy()
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))) / F.sum(
        "weight"
    ).over(order.rowsBetween(0, W.unboundedFollowing))
    rows = rows.withColumn("level", level)
    rate = F.max(F.when(F.col("level") < F.col("ratio"), F.col("level"))).over(every)
    return rows.withColumn("rate", rate).select(
        "key", "source_size", F.coalesce(F.least(F.col("most"), F.col("rate") * F.col("weight")), F.col("most")).alias("target"), "slope"
    )


def _planned(rows: DataFrame, sized: DataFrame, key: str, bucket: str, order: str, size: str, tie: str, out: dict[str, str], **options) -> DataFrame:
    """rows with the columns named in `out`: source_size, target, slope, start (words of the source before the row) and
    copies. sized: (key, source, bucket, size) of the same rows."""
    buckets = sized.groupBy("key", "bucket").agg(F.first("source").alias("source"), F.sum("size").alias("words"))
    goals = targets(buckets.groupBy("key").agg(F.first("source").alias("source"), F.sum("words").alias("source_size")), **options)
    before = F.coalesce(F.sum("words").over(W.partitionBy("key").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    laid = buckets.withColumn("before", before).join(goals, "key").select(
        F.col("key").alias(key), F.col("bucket").alias(bucket), F.col("before").alias(out["start"]),
        *[F.col(c).alias(out[c]) for c in ("source_size", "target", "slope")],
    )
    inner = F.sum(size).over(W.partitionBy(key, bucket).orderBy(order, tie, size).rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn(out["copies"], F.coalesce(inner, F.lit(0))).join(laid, [key, bucket])
    start = F.col(out["start"]) + F.col(out["copies"])
    rows = rows.withColumn(out["start"], start)
    passes = F.when(F.col(out["source_size"]) > 0, F.floor(F.col(out["target"]) / F.col(out["source_size"]))).otherwise(0)
    rest = F.col(out["target"]) - passes * F.col(out["source_size"])
    extra = (F.col(out["start"]) + F.col(size) / 2 < rest).cast("long")
    return rows.withColumn(out["copies"], passes.cast("long") + extra)


def position(copy: Column, start: Column, size: Column, source_size: Column, target: Column, slope: Column) -> Column:
    """The time in [0, 1] at which the middle of a copy is asked for: the inverse of t + slope (t^2 - t)."""
    asked = F.when(target > 0, F.least((copy * source_size + start + size / 2) / target, F.lit(1.0))).otherwise(F.lit(0.0))
    b = 1 - slope
    return 2 * asked / (b + F.sqrt(b * b + 4 * slope * asked))


COLUMNS = ("source_size", "target", "slope", "start", "copies")


def _part(position: Column, parts: int) -> Column:
    return F.least(F.floor(position * parts), F.lit(parts - 1)).cast("int")


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix", **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken (words the mix takes, repeats counted), and for its
    copies in turn positions, their times in training, and ranks, their places among all copies in training order (by position,
    then id and copy, from 0)."""
    sized = checkpoint(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"), order_hash(F.col(id_col), seed).alias("order")
        ).select("*", _key(F.col("source")).alias("key"), F.substring("order", 1, 3).alias("bucket"))
    )
    rows = _planned(sized.drop("source"), sized, "key", "bucket", "order", "size", "doc_id", {c: c for c in COLUMNS}, **options)
    place = lambda copy: position(copy, F.col("start"), F.col("size"), F.col("source_size"), F.col("target"), F.col("slope"))
    turns = F.when(F.col("copies") > 0, F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).otherwise(F.array().cast("array<long>"))
    nth = F.row_number().over(W.partitionBy("key", "bucket").orderBy("order", "doc_id", "size"))
    rows = checkpoint(rows.withColumns({"nth": nth, "positions": F.transform(turns, place)}).drop("order", "start", "slope"))
    ranked = _ranked(rows.select("key", "bucket", "nth", "doc_id", F.posexplode("positions").alias("copy", "position")), ["position", "doc_id", "copy"])
    ranks = ranked.groupBy("key", "bucket", "nth").agg(F.transform(F.array_sort(F.collect_list(F.struct("copy", "rank"))), lambda r: r["rank"]).alias("ranks"))
    return rows.join(ranks, ["key", "bucket", "nth"], "left").select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "positions",
        F.coalesce("ranks", F.array().cast("array<long>")).alias("ranks"),
    )


def _ranked(copies: DataFrame, order: list[str]) -> DataFrame:
    """copies with their rank in the order given, which begins with the position. The only window over all parts runs over their
    counts."""
    parts = int(copies.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies = copies.withColumn("part", _part(F.col("position"), parts))
    counts = copies.groupBy("part").agg(F.count("*").alias("n"))
    ahead = counts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("ahead"))
    inside = F.row_number().over(W.partitionBy("part").orderBy(*order))
    return copies.withColumn("inside", inside).join(F.broadcast(ahead), "part").withColumn("rank", F.col("ahead") + F.col("inside") - 1)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix", position_col: str | None = None, **options) -> DataFrame:
    """The mixed corpus in the columns of docs: every document as often as the plan takes it, range-sorted by training
    position (partition i holds the i-th part of training time). position_col keeps the position under that name."""
    size, order, key, bucket, copy, at, *names = fresh(docs, "size", "order", "key", "bucket", "copy", "position", *COLUMNS)
    out = dict(zip(COLUMNS, names, strict=True))
    rows = docs.withColumns({
        size: word_count(F.col(text_col)), order: order_hash(F.col(id_col), seed), key: _key(F.col(source_col).cast("string")),
    }).withColumn(bucket, F.substring(order, 1, 3))
    sized = rows.select(F.col(key).alias("key"), F.col(source_col).cast("string").alias("source"), F.col(bucket).alias("bucket"), F.col(size).alias("size"))
    rows = _planned(rows, sized, key, bucket, order, size, id_col, out, **options)
    rows = rows.where(F.col(out["copies"]) > 0).withColumn(copy, F.explode(F.sequence(F.lit(0).cast("long"), F.col(out["copies"]) - 1)))
    rows = rows.withColumn(at, position(F.col(copy), F.col(out["start"]), F.col(size), F.col(out["source_size"]), F.col(out["target"]), F.col(out["slope"])))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionById(parts, _part(F.col(at), parts)).sortWithinPartitions(at, id_col, copy)
    return rows.select(*docs.columns, *([F.col(at).alias(position_col)] if position_col else []))
