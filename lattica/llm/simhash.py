"""SimHash near-duplicates through a hierarchical index in Gray order.

A fingerprint has 64 bits; two of them link at `distance` or fewer differing bits. Texts with one fingerprint count as one
node, named by its smallest doc_id.

Candidate groups: the 64 bits are cut into distance + r blocks; two linked fingerprints agree in r blocks at least, so
every choice of r blocks is a table whose groups share those bits. r grows with the number of fingerprints and keeps the
groups near GROUP_TARGET members; no link is lost at any r. Inside a group the fingerprints are sorted by Gray rank (Spark
sorts them), runs of FANOUT neighbours form a node that holds the bits all its members share (mask and value), runs of
nodes form the nodes above. The self-join walks pairs of nodes from the top, and drops a pair with all below it when the
bits shared on both sides already differ in more than `distance` places. Item pairs that remain are exact links, kept only
as a spanning forest per task: a group of n copies gives n - 1 edges, not all its pairs.

A group of more than GROUP_MOST members is split into parts, and every pair of parts is a task of its own.

Defined results: a null or empty text has fingerprint zero and links like any other. Rows without a doc_id carry the
component of their fingerprint (null if no row with a doc_id has it). Repeated rows give repeated results. An empty table
gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import checkpoint, small_batches, text_slices
from lattica.llm.components import components

SEED = 42
FANOUT = 8
#: Mean members of a candidate group that r is chosen for.
GROUP_TARGET = 1000
#: Members of a group that one task takes at most; larger ones are dealt out as pairs of parts.
GROUP_MOST = 20_000
#: Node pairs looked at together.
PAIRS_AT_ONCE = 8192


def shingle_hashes(raw: bytes, width: int) -> list[int]:
    words = raw.lower().split()
    if not words:
        return []
    line = b" ".join(words)
    h = xxhash.xxh64_intdigest
    if len(words) <= width:
        return [h(line, SEED)]
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    return [h(line[s : e - 1], SEED) for s, e in zip(starts, starts[width:], strict=False)]


def _fingerprints(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for piece in text_slices(batches, "text"):
        lists = [shingle_hashes((x or "").encode(), width) for x in piece.column("text").to_pylist()]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        out = np.zeros(len(lists), np.uint64)
        some = np.flatnonzero(counts)
        if len(some):
            total = int(counts.sum())
            flat = np.fromiter((x for one in lists for x in one), np.uint64, total)
            bits = np.unpackbits(flat.view(np.uint8).reshape(total, 8), axis=1, bitorder="little")
            starts = np.concatenate(([0], np.cumsum(counts[some])[:-1]))
            set_in = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
            over = (2 * set_in > counts[some][:, None]).astype(np.uint8)
            out[some] = np.packbits(over, axis=1, bitorder="little").view(np.uint64).ravel()
        yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(out.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """(doc_id, fp): the 64-bit SimHash of each text's word shingles, as a signed long."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda b: _fingerprints(b, width), "doc_id long, fp long")


def gray_rank(code: Column) -> Column:
    """The place of a code in the Gray sequence: bit i is the parity of the code's bits from i upwards."""
    for k in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, k))
    return code


def block_masks(distance: int, agree: int) -> list[int]:
    """For each choice of `agree` out of distance + agree blocks of the 64 bits, the mask of their bits (signed)."""
    n = distance + agree
    cuts = [64 * i // n for i in range(n + 1)]
    blocks = [sum(1 << b for b in range(cuts[i], cuts[i + 1])) for i in range(n)]
    masks = [sum(blocks[i] for i in pick) for pick in combinations(range(n), agree)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def blocks_to_agree(n: int, distance: int) -> int:
    """The smallest r whose groups, of n fingerprints, would hold GROUP_TARGET members on average if bits were even."""
    r = 1
    while r < 4 and n > GROUP_TARGET << (64 * r // (distance + r)):
        r += 1
    return r


def _levels(codes: np.ndarray, group: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """From the items upwards: shared mask, shared value, first child and one past the last child of every node. The top
    level has one node per group. codes are in Gray order within each group."""
    full = np.full(len(codes), ~np.uint64(0))
    levels = [(full, codes, np.arange(len(codes)), np.arange(len(codes)) + 1)]
    while True:
        mask, value, *_ = levels[-1]
        first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        if len(first) == len(group) and len(levels) > 1:
            return levels
        place = np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group))))
        heads = np.flatnonzero(place % FANOUT == 0)
        all_set = np.bitwise_and.reduceat(value, heads)
        any_set = np.bitwise_or.reduceat(value, heads)
        shared = np.bitwise_and.reduceat(mask, heads) & ~(all_set ^ any_set)
        levels.append((shared, all_set & shared, heads, np.append(heads[1:], len(group))))
        group = group[heads]


def _links(codes: np.ndarray, group: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of item numbers, of one group, at `distance` or fewer differing bits."""
    if not len(codes):
        return
    levels = _levels(codes, group)
    roots = np.arange(len(levels[-1][0]))
    stack = [(len(levels) - 1, roots[i : i + PAIRS_AT_ONCE], roots[i : i + PAIRS_AT_ONCE]) for i in range(0, len(roots), PAIRS_AT_ONCE)]
    while stack:
        level, a, b = stack.pop()
        _, _, first, last = levels[level]
        na, nb = last[a] - first[a], last[b] - first[b]
        size = na * nb
        which = np.repeat(np.arange(len(a)), size)
        at = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
        x, y = first[a][which] + at // nb[which], first[b][which] + at % nb[which]
        mask, value, *_ = levels[level - 1]
        near = (x < y) if level == 1 else (x <= y)
        near &= np.bitwise_count((value[x] ^ value[y]) & mask[x] & mask[y]) <= distance
        x, y = x[near], y[near]
        if level == 1:
            yield x, y
        else:
            stack.extend((level - 1, x[i : i + PAIRS_AT_ONCE], y[i : i + PAIRS_AT_ONCE]) for i in range(0, len(x), PAIRS_AT_ONCE))


def _union(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Join the components of x[i] and y[i]; label stays flat: every item names the smallest item of its component."""
    while True:
        a, b = label[x], label[y]
        differ = a != b
        if not differ.any():
            return
        x, y = x[differ], y[differ]
        a, b = a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def _forest(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Edges that connect, within each group, what its links connect. Rows come sorted by group and Gray rank."""

    def edges(rows: pa.Table) -> pa.RecordBatch:
        key = [rows.column(c).to_numpy() for c in ("t", "bits", "p", "q")]
        codes, node = rows.column("fp").to_numpy().view(np.uint64), rows.column("node").to_numpy()
        change = np.zeros(len(codes), bool)
        for k in key:
            change[1:] |= k[1:] != k[:-1]
        group = np.cumsum(change)
        label = np.arange(len(codes))
        for x, y in _links(codes, group, distance):
            _union(label, x, y)
        linked = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(node[linked]), pa.array(node[label[linked]])], names=["a", "b"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([*held, batch])
        last = [rows.column(c)[-1].as_py() for c in ("t", "bits", "p", "q")]
        same = np.ones(rows.num_rows, bool)
        for c, v in zip(("t", "bits", "p", "q"), last, strict=True):
            same &= rows.column(c).to_numpy() == v
        cut = int(np.flatnonzero(same)[0])
        if cut:
            yield edges(rows.slice(0, cut))
        held = rows.slice(cut).combine_chunks().to_batches()
    if held:
        yield edges(pa.Table.from_batches(held))


def link_edges(nodes: DataFrame, distance: int = 4) -> DataFrame:
    """(a, b) edges between the nodes (fp, node) that connect exactly what links of `distance` bits connect."""
    agree = blocks_to_agree(nodes.count(), distance)
    masks = F.array(*[F.lit(m).cast("long") for m in block_masks(distance, agree)])
    rows = nodes.select("fp", "node", F.posexplode(masks).alias("t", "mask")).select("fp", "node", "t", F.col("fp").bitwiseAND(F.col("mask")).alias("bits"))
    large = rows.groupBy("t", "bits").count().where(F.col("count") > GROUP_MOST).select("t", "bits", F.ceil(F.col("count") * 2 / GROUP_MOST).cast("int").alias("parts"))
    rows = rows.join(large, ["t", "bits"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    rows = rows.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.where("parts = 1 or part <> other")
    rows = rows.select("t", "bits", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "fp", "node", gray_rank(F.col("fp")).alias("gray"))
    rows = rows.repartition("t", "bits", "p", "q").sortWithinPartitions("t", "bits", "p", "q", "gray").drop("gray")
    return rows.mapInArrow(lambda b: _forest(b, distance), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, distance: int = 4) -> DataFrame:
    """(doc_id, fp, component_id) for every document: its fingerprint and the smallest doc_id reachable over links."""
    prints = checkpoint(fingerprints(docs, id_col, text_col, width))
    nodes = checkpoint(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")))
    linked = components(link_edges(nodes, distance))
    named = nodes.join(linked, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(named, "fp", "left").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, distance: int = 4) -> DataFrame:
    """The documents with the smallest id of their component, one row each, in the columns they came with. Rows without an
    id can't be linked and stay."""
    found = near_duplicates(docs, id_col, text_col, width, distance)
    first = found.where("component_id = doc_id").select(F.col("doc_id").alias(id_col)).distinct()
    kept = docs.join(first, id_col, "left_semi").dropDuplicates([id_col])
    return kept.unionByName(docs.where(F.col(id_col).isNull())).select(*docs.columns)
