"""SentencePiece encoding with sampled segmentations, and lossless decoding.

A text's lattice has an edge for every vocabulary piece that matches at a place. Forward filtering gives each node the total
weight of the paths that reach it; backward sampling walks from the end and draws every edge in proportion to the weight of
the paths through it, which samples whole segmentations from the model's distribution. The random numbers are a hash of the
row key and of the node's place in the text, so a row's segmentation is the same on every run, machine and partitioning.

No piece has a space after a non-space or a line feed inside, so the lattice falls apart at these places into words. A long
word, as text without spaces makes, is cut further wherever no piece that matches lies across: every path passes there, so both
sides are independent. The forward pass of such a segment is done once per chunk of texts, and all draws of a chunk run side by
side in numpy; the few segments that are still long, such as one letter many times over, are walked one by one, edge by edge.
Path weights are kept relative to the newest node's in double precision, which holds them for the longest piece: none is clipped.

A space is the piece character U+2581, and a code point without a piece, U+2581 itself included, is spelled in byte pieces;
nothing is normalised and no space is put in front, so decoding gives the text back exactly.

The vocabulary orders its pieces by merge rank; a piece's weight is (rank + 2) ** -alpha, a Zipf law over that order.

Defined results: a null text gives null pieces and decodes to null; an empty one gives none and decodes to an empty text; a
null key is a key of its own; repeated rows get equal pieces. An empty table gives an empty result. Columns of the input
other than the result columns pass through.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lattica.llm.common import small_batches, text_slices
from lattica.llm.textkernel import mix

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 1.0
SEED = "pieces"
#: Texts are worked on together up to so many bytes.
CHUNK = 1 << 20

SPACE_MARK = 0x2581
#: Stands for U+2581 in a text, which no piece may match.
OUTSIDE = 0x110000
WORDS = re.compile(r" *[^ \n]+| +|\n")
#: Words above the first length (in code points) are cut further; segments above the second are walked one by one.
CUT_ABOVE, WALK_ABOVE = 48, 256
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


@dataclass
class Vocabulary:
    """Pieces by id: the bytes each decodes to (none for control pieces), and how each matches text (None: it doesn't)."""

    decoded: list[bytes]
    surface: list[str | None]
    rank: list[float]
    byte_id: np.ndarray = field(default_factory=lambda: np.zeros(256, np.int32))

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Read on the driver; executors get it with the task and need no file."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        out = cls([b""] * n, [None] * n, [float(n)] * n)
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                out.decoded[i] = bytes([int(piece[3:5], 16)])
                out.byte_id[out.decoded[i][0]] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                if re.search(r"[^▁]▁|\n", piece):
                    raise ValueError(f"piece {i} crosses a word boundary: {piece!r}")
                out.decoded[i], out.surface[i] = piece.replace("▁", " ").encode(), piece
                out.rank[i] = min(float(n), -model.get_score(i))
        return out


class Table:
    """An open-addressing hash table of all pieces and their prefixes, looked up for many keys at once."""

    def __init__(self, vocabulary: Vocabulary, alpha: float):
        value: dict[int, int] = {}
        self.longest = 1
        for i, piece in enumerate(vocabulary.surface):
            if not piece:
                continue
            self.longest = max(self.longest, len(piece))
            h = 0
            for k, c in enumerate(piece):
                h = (h * int(_BASE) + ord(c) + 1) % (1 << 64)
                if k + 1 == len(piece):
                    value[h] = i
                else:
                    value.setdefault(h, -1)
        self.bits = max(12, (4 * len(value)).bit_length())
        size = 1 << self.bits
        self.keys, self.values = np.zeros(size, np.uint64), np.full(size, -2, np.int32)
        taken = np.zeros(size, bool)
        for h, v in value.items():
            at = self._slot(h)
            while taken[at]:
                at = (at + 1) % size
            taken[at], self.keys[at], self.values[at] = True, h, v
        rank = np.array(vocabulary.rank)
        self.weight = ((rank + 2) ** -alpha).astype(np.float32)
        self.fallback = np.float32((len(rank) + 2.0) ** -alpha)
        if self.longest * abs(alpha) * np.log10(len(rank) + 2.0) > 300:
            raise ValueError("path weights over the longest piece don't fit a double")

    def _slot(self, h: int) -> int:
        return (h * int(_BASE) % (1 << 64)) >> (64 - self.bits)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece id; -1: only the beginning of pieces; -2: neither."""
        at = ((h * _BASE) >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.full(len(h), -2, np.int32)
        left = np.arange(len(h))
        while len(left):
            v, same = self.values[at[left]], self.keys[at[left]] == h[left]
            out[left[same]] = v[same]
            left = left[~same & (v != -2)]
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)
        return out


def _code_points(text: str) -> np.ndarray:
    cps = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    cps[cps == SPACE_MARK] = OUTSIDE
    cps[cps == 0x20] = SPACE_MARK
    return cps


def _matches(cps: np.ndarray, left: np.ndarray, table: Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, starts, pieces) of the pieces of each length that match; left: code points from a place to its word's end."""
    at, h = np.arange(len(cps)), np.zeros(len(cps), np.uint64)
    for length in range(1, table.longest + 1):
        h = h * _BASE + cps[at + length - 1] + np.uint64(1)
        found = table.find(h)
        hit = found >= 0
        yield length, at[hit], found[hit]
        alive = (found > -2) & (left[at] > length)
        at, h = at[alive], h[alive]
        if not len(at):
            return


def segments(word: str, table: Table) -> list[str]:
    """The word cut wherever no piece that matches lies across."""
    n = len(word)
    across = np.zeros(n + 1, np.int64)
    for length, starts, _ in _matches(_code_points(word), np.arange(n, 0, -1), table):
        if length > 1:
            across += np.bincount(starts + 1, minlength=n + 1)[: n + 1] - np.bincount(starts + length, minlength=n + 1)[: n + 1]
    cuts = np.flatnonzero(np.cumsum(across)[:n] == 0).tolist()
    return [word[i:j] for i, j in zip(cuts, [*cuts[1:], n], strict=True)]


class Walk:
    """The lattice of one long segment: its edges by the node where they end, with their cumulative probabilities there."""

    def __init__(self, segment: str, table: Table):
        cps, n = _code_points(segment), len(segment)
        ends, lengths, pieces = [], [], []
        alone = np.ones(n, bool)
        for length, starts, found in _matches(cps, np.arange(n, 0, -1), table):
            if length == 1:
                alone[starts] = False
            ends.append(starts + length)
            lengths.append(np.full(len(starts), length))
            pieces.append(found.astype(np.int64))
        bare = np.flatnonzero(alone)
        ends, lengths = np.concatenate([*ends, bare + 1]), np.concatenate([*lengths, np.ones(len(bare), np.int64)])
        pieces = np.concatenate([*pieces, -1 - cps[bare].astype(np.int64)])
        order = np.lexsort((lengths, ends))
        ends, lengths, pieces = ends[order], lengths[order], pieces[order]
        self.n, self.lengths, self.pieces = n, lengths.tolist(), pieces.tolist()
        self.first = np.searchsorted(ends, np.arange(n + 2)).tolist()
        weights = np.where(pieces >= 0, table.weight[np.maximum(pieces, 0)], table.fallback).astype(np.float64).tolist()
        total, self.cumulative = [1.0], [0.0] * len(weights)
        for node in range(1, n + 1):
            run, a, b = 0.0, self.first[node], self.first[node + 1]
            for e in range(a, b):
                run += total[node - self.lengths[e]] * weights[e]
                self.cumulative[e] = run
            for e in range(a, b):
                self.cumulative[e] /= run
            total.append(run)
            if run < 1e-150:  # only as many nodes back as the longest piece count from here
                for x in range(max(0, node - table.longest), node + 1):
                    total[x] *= 1e150

    def draw(self, u: list[float]) -> list[int]:
        """Pieces from the end backwards; u: a number in [0, 1) per node from 1 on."""
        out, node = [], self.n
        while node:
            e, last = self.first[node], self.first[node + 1] - 1
            while e < last and self.cumulative[e] <= u[node - 1]:
                e += 1
            out.append(self.pieces[e])
            node -= self.lengths[e]
        return out


def forward(words: list[str], table: Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lattices of the words. Words are ranked by length, longest first, so the words that reach place p are the first
    ones, and the node p + 1 of the word of rank r is row level[p] + r. Per node: the cumulative probability and the piece
    (below 0: code point -1 - it, spelled in bytes) of the edges of length 1, 2, ... that end there. Returns the rank and
    length of each word, level, cumulative probabilities and pieces."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(-lengths, kind="stable")
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    sizes = lengths[order]
    active = np.searchsorted(-sizes, -np.arange(int(sizes[0])), "left")  # words longer than p
    level = np.concatenate(([0], np.cumsum(active)))
    cps, n = _code_points("".join(words)), int(lengths.sum())
    start = np.cumsum(lengths) - lengths
    place = np.arange(n) - np.repeat(start, lengths)
    row = level[place] + np.repeat(rank, lengths)
    left = np.repeat(lengths, lengths) - place  # code points from here to the word's end
    layers = [(row[starts + length - 1], found) for length, starts, found in _matches(cps, left, table)]
    k = len(layers)
    weight, piece = np.zeros((k, n), np.float32), np.zeros((n, k), np.int32)
    weight[0] = table.fallback
    piece[row, 0] = -1 - cps.astype(np.int64)
    for i, (ends, found) in enumerate(layers):
        weight[i, ends], piece[ends, i] = table.weight[found], found
    recent = np.zeros((k, len(words)))  # total weight of the nodes 1, 2, ... places back, relative to the newest
    recent[0] = 1
    for p, m in enumerate(active.tolist()):
        wide = min(p + 1, k)
        recent = recent[:, :m]
        run = weight[:wide, level[p] : level[p + 1]] * recent[:wide]
        for i in range(1, wide):
            run[i] += run[i - 1]
        total = run[-1].copy()
        weight[:wide, level[p] : level[p + 1]] = run / total
        weight[wide:, level[p] : level[p + 1]] = 1
        recent = np.concatenate((np.ones((1, m)), recent[: k - 1] / total))
    weight = np.ascontiguousarray(weight.T)
    return rank, lengths, level, weight, piece


def encode(texts: list[str], seeds: np.ndarray, table: Table, byte_id: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts end to end, and their offsets. seeds: one uint64 per text."""
    found = [WORDS.findall(x) for x in texts]
    cut: dict[str, list[str]] = {}
    for i, words in enumerate(found):
        if len(texts[i]) > CUT_ABOVE and len(max(words, key=len)) > CUT_ABOVE:
            for w in words:
                if len(w) > CUT_ABOVE and w not in cut:
                    cut[w] = segments(w, table)
            found[i] = [x for w in words for x in (cut[w] if len(w) > CUT_ABOVE else (w,))]
    n_words = np.fromiter(map(len, found), np.int64, len(found))
    known = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(found)))}
    if not known:
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    word = np.fromiter(map(known.__getitem__, chain.from_iterable(found)), np.int64, int(n_words.sum()))
    lengths = np.fromiter(map(len, known), np.int64, len(known))
    walks = {i: Walk(w, table) for w, i in known.items() if lengths[i] > WALK_ABOVE}
    short = [w for w in known if len(w) <= WALK_ABOVE]
    rank = np.zeros(len(known), np.int64)
    if short:
        rank[lengths <= WALK_ABOVE], _, level, cumulative, piece = forward(short, table)
    size = lengths[word]
    owner = np.repeat(np.arange(len(texts)), n_words)
    place = np.cumsum(size) - size  # of a word in its text
    text_start = np.concatenate(([0], np.cumsum(n_words)[:-1]))
    first = np.where(n_words > 0, place[np.minimum(text_start, len(word) - 1)], 0)
    place = (place - first[owner]).astype(np.uint64)
    seed = seeds[owner]
    chance = lambda who, node: (mix(seed[who] ^ mix(place[who] + node.astype(np.uint64))) >> np.uint64(11)).astype(np.float64) * 2.0**-53
    node, active, drawn, whose = size.copy(), np.flatnonzero(size <= WALK_ABOVE), [], []
    base = rank[word]
    while len(active):
        at = base[active] + level[node[active] - 1]
        c = cumulative[at]
        length = (c <= chance(active, node[active])[:, None]).sum(axis=1)
        drawn.append(piece[at, length])
        whose.append(active)
        node[active] -= length + 1
        active = active[node[active] > 0]
    steps = np.zeros(len(word), np.int64)
    for w in whose:
        steps[w] += 1
    walked = {}
    for x in np.flatnonzero(size > WALK_ABOVE).tolist() if walks else ():
        walked[x] = walks[word[x]].draw(chance(np.array([x]), np.arange(1, size[x] + 1)).tolist())
        steps[x] = len(walked[x])
    ends = np.cumsum(steps)
    flat = np.empty(int(ends[-1]), np.int32)
    for i, (w, d) in enumerate(zip(whose, drawn, strict=True)):
        flat[ends[w] - 1 - i] = d
    for x, ids in walked.items():
        flat[ends[x] - len(ids) : ends[x]] = ids[::-1]
    bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(n_words)))]
    spelled = flat < 0
    if spelled.any():
        cps, which = np.unique(-1 - flat[spelled], return_inverse=True)
        raw = [chr(SPACE_MARK if c == OUTSIDE else c).encode() for c in cps.tolist()]
        width = np.ones(len(flat), np.int64)
        width[spelled] = np.array([len(x) for x in raw])[which]
        ids = np.array([[*byte_id[list(x)], *[0] * (4 - len(x))] for x in raw], np.int32)
        after = np.cumsum(width)
        out = np.repeat(flat, width)
        inner = np.arange(len(out)) - np.repeat(after - width, width)
        row = np.zeros(len(flat), np.int64)
        row[spelled] = which
        is_spelled = np.repeat(spelled, width)
        out[is_spelled] = ids[np.repeat(row, width)[is_spelled], inner[is_spelled]]
        bounds, flat = np.concatenate(([0], after))[bounds], out
    return flat, bounds


def decode(ids: list[int], decoded: list[bytes]) -> str:
    return b"".join(map(decoded.__getitem__, ids)).decode()


class Codec:
    """Encoder and decoder of Arrow batches; the vocabulary travels in a broadcast, its tables are built once per worker."""

    _built: tuple[object, Table] | None = None

    def __init__(self, vocabulary: Vocabulary, alpha: float = ALPHA, seed: str = SEED):
        self.vocabulary, self.alpha, self.seed = vocabulary, alpha, seed

    def table(self) -> Table:
        key = (len(self.vocabulary.decoded), self.alpha, hashlib.md5(repr(self.vocabulary.surface).encode()).digest())
        if Codec._built is None or Codec._built[0] != key:
            Codec._built = (key, Table(self.vocabulary, self.alpha))
        return Codec._built[1]

    def seeds(self, keys: pa.Array) -> np.ndarray:
        return np.array([xxhash.xxh64_intdigest(f"{self.seed}:{k}") for k in keys.to_pylist()], np.uint64)

    def encode_batches(self, batches: Iterator[pa.RecordBatch], key: str, text: str) -> Iterator[tuple[pa.RecordBatch, list[str | None], np.ndarray, np.ndarray]]:
        table = self.table()
        for piece in text_slices(batches, text, CHUNK):
            texts = piece.column(text).to_pylist()
            ids, bounds = encode([x or "" for x in texts], self.seeds(piece.column(key)), table, self.vocabulary.byte_id)
            yield piece, texts, ids, bounds


def sample_encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out_col: str = "piece_ids", vocabulary: str = VOCABULARY, alpha: float = ALPHA, seed: str = SEED) -> DataFrame:
    """docs with out_col, array<int>, in place of the text: a sampled segmentation seeded by the row key."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Codec(Vocabulary.load(vocabulary), alpha, seed))
    fields = [f for f in docs.schema.fields if f.name not in (text_col, out_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts, ids, bounds in shared.value.encode_batches(batches, id_col, text_col):
            null = np.array([x is None for x in texts] + [False])
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32), mask=null), pa.array(ids))
            yield pa.RecordBatch.from_arrays([*[piece.column(f.name) for f in fields], lists], names=[*[f.name for f in fields], out_col])

    return docs.mapInArrow(run, T.StructType([*fields, T.StructField(out_col, T.ArrayType(T.IntegerType()))]))


def decode_pieces(rows: DataFrame, ids_col: str = "piece_ids", out_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """rows with out_col, the decoded text, in place of the piece ids."""
    small_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(Vocabulary.load(vocabulary).decoded)
    fields = [f for f in rows.schema.fields if f.name not in (ids_col, out_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x is None else decode(x, shared.value) for x in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in fields], pa.array(texts, pa.string())], names=[*[f.name for f in fields], out_col])

    return rows.mapInArrow(run, T.StructType([*fields, T.StructField(out_col, T.StringType())]))


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, alpha: float = ALPHA, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, n_chars, n_pieces, sha256 of the piece ids (little-endian int32) and of the decoded
    text, and whether decoding gave the text back. A null text has no pieces and counts as given back."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Codec(Vocabulary.load(vocabulary), alpha, seed))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoded = shared.value.vocabulary.decoded
        for piece, texts, ids, bounds in shared.value.encode_batches(batches, "doc_id", "text"):
            own = [ids[a:b] for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False)]
            back = [decode(x.tolist(), decoded) for x in own]
            sha = lambda x: hashlib.sha256(x).hexdigest()
            yield pa.RecordBatch.from_arrays([
                piece.column("doc_id"), pa.array([len(x or "") for x in texts], pa.int64()), pa.array([len(x) for x in own], pa.int64()),
                pa.array([sha(x.astype("<i4").tobytes()) for x in own], pa.string()), pa.array([sha(x.encode()) for x in back], pa.string()),
                pa.array([x == (y or "") for x, y in zip(back, texts, strict=True)]),
            ], names=["doc_id", "n_chars", "n_pieces", "pieces_sha256", "decoded_sha256", "lossless"])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_chars long, n_pieces long, pieces_sha256 string, decoded_sha256 string, lossless boolean")
