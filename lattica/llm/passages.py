"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages (PASSAGE bytes each). Every passage is encoded as how often each pair of neighbouring
character classes occurs in it, plus how much of it repeats earlier words or lines of the document; a hidden layer makes it
a vector. Gated attention (tanh times sigmoid) gives every passage a weight, the weights of a document's passages add up to
one, and a logistic unit scores the weighted passage vector. The document's label trains all of it.

Training uses a bounded sample of labelled documents, up to `per_class` of each label, the smallest by a hash of doc_id, and
every passage of them; scoring uses every passage of every text. Copies of a row train as one document.

Defined results: a null or empty text is a bag with one empty passage and gets a score like any other; repeated rows get
equal scores; rows without a doc_id are scored and never trained on; a doc_id with labels that disagree counts as the
majority (a tie: 1). Without documents of both labels the score is the share of label 1 (0.5 without any label). An empty
table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import crc_mod, hash_sample, one_text, small_batches, text_slices
from lattica.llm.textkernel import SPACE, Texts, repeats, windows

PASSAGE = 1024
PER_CLASS = 1500
HIDDEN, GATE, EPOCHS, RATE, DECAY = 24, 16, 160, 0.02, 1e-3

#: Character classes of bytes: a rule, then single marks with a class of their own.
_CLASS = np.zeros(256, np.uint8)
_CLASS[list(range(0x61, 0x7B))] = 1
_CLASS[list(range(0x41, 0x5B))] = 2
_CLASS[list(range(0x30, 0x3A))] = 3
_CLASS[list(range(0x80, 0x100))] = 4
for _i, _marks in enumerate((b" ", b"\n\r\t\v\f", b".", b",;:", b"!", b"?", b"#*$%&~^", b"|/\\<>", b"\"'()-", b"=+@_{}[]`")):
    _CLASS[list(_marks)] = 5 + _i
CLASSES = 15
WIDTH = CLASSES * CLASSES + 4


def encode_passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The encoded passages of all texts, and the text that each belongs to; every text has one at least."""
    texts = Texts.of(column)
    data, n, size = texts.data, len(texts), np.diff(texts.offsets)
    per_text = np.maximum(1, -(-size // PASSAGE))
    first = np.cumsum(per_text) - per_text
    total = int(per_text.sum())
    owner = np.repeat(np.arange(n), per_text)
    out = np.zeros((total, WIDTH), np.float32)
    if len(data):
        text_of = np.repeat(np.arange(n), size)
        passage = first[text_of] + (np.arange(len(data)) - texts.offsets[:-1][text_of]) // PASSAGE
        kind = _CLASS[data].astype(np.int64)
        inside = text_of[:-1] == text_of[1:]
        pair = (passage[:-1] * (CLASSES * CLASSES) + kind[:-1] * CLASSES + kind[1:])[inside]
        counts = np.bincount(pair, minlength=total * CLASSES * CLASSES).reshape(total, -1)
        out[:, : CLASSES * CLASSES] = np.sqrt(counts / np.maximum(1, counts.sum(axis=1, keepdims=True)))
        s, e, w_owner = texts.runs(~SPACE[data])
        hashes = texts.hashes(s, e)
        words = np.bincount(passage[s], minlength=total)
        for column_at, width in ((0, 1), (1, 4)):
            at, keys = windows(hashes, w_owner, width)
            _, later = repeats(keys)
            out[:, CLASSES * CLASSES + column_at] = np.bincount(passage[s[at[later]]], minlength=total) / np.maximum(1, words)
        ls, le, l_owner = texts.runs(data != 0x0A)
        _, later = repeats(windows(texts.hashes(ls, le), l_owner, 1)[1])
        out[:, -2] = np.bincount(passage[ls[later]], minlength=total) / np.maximum(1, np.bincount(passage[ls], minlength=total))
        out[:, -1] = np.log1p(words) / 6
    return out, owner


@dataclass
class Model:
    """Weights of the network; None stands for a constant score."""

    weights: dict[str, np.ndarray] | None
    constant: float = 0.5

    def score(self, x: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        if self.weights is None:
            return np.full(n, self.constant)
        return 1 / (1 + np.exp(-_network(self.weights, x, owner, n)["logit"].astype(np.float64)))


def _network(w: dict[str, np.ndarray], x: np.ndarray, owner: np.ndarray, n: int) -> dict[str, np.ndarray]:
    """owner ascending, every document with one passage at least."""
    starts = np.searchsorted(owner, np.arange(n))
    h = np.maximum(0, x @ w["We"] + w["be"])
    t, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
    a = (t * g) @ w["a"]
    a = np.exp(a - np.maximum.reduceat(a, starts)[owner])
    a /= np.add.reduceat(a, starts)[owner]
    z = np.add.reduceat(a[:, None] * h, starts, axis=0)
    return {"h": h, "t": t, "g": g, "attention": a, "z": z, "logit": z @ w["c"] + w["d"][0], "starts": starts}


def train(x: np.ndarray, owner: np.ndarray, labels: np.ndarray, seed: int = 7) -> Model:
    """Full-batch Adam on the cross-entropy, both labels weighing the same."""
    n = len(labels)
    if n == 0 or labels.min() == labels.max():
        return Model(None, float(labels.mean()) if n else 0.5)
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    w = {"We": draw(WIDTH, HIDDEN) * 3, "be": np.zeros(HIDDEN, np.float32), "V": draw(HIDDEN, GATE), "U": draw(HIDDEN, GATE), "a": draw(GATE), "c": draw(HIDDEN), "d": np.zeros(1, np.float32)}
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())).astype(np.float32) / n
    first, second = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}
    for step in range(1, EPOCHS + 1):
        f = _network(w, x, owner, n)
        d_logit = ((1 / (1 + np.exp(-f["logit"])) - labels) * weight).astype(np.float32)
        grad = {"c": f["z"].T @ d_logit, "d": np.array([d_logit.sum()], np.float32)}
        d_z = d_logit[:, None] * w["c"]
        d_a = (f["h"] * d_z[owner]).sum(axis=1)
        d_s = f["attention"] * (d_a - np.add.reduceat(f["attention"] * d_a, f["starts"])[owner])
        d_tg = d_s[:, None] * w["a"]
        grad["a"] = (f["t"] * f["g"]).T @ d_s
        d_v, d_u = d_tg * f["g"] * (1 - f["t"] ** 2), d_tg * f["t"] * f["g"] * (1 - f["g"])
        grad["V"], grad["U"] = f["h"].T @ d_v, f["h"].T @ d_u
        d_h = (f["attention"][:, None] * d_z[owner] + d_v @ w["V"].T + d_u @ w["U"].T) * (f["h"] > 0)
        grad["We"], grad["be"] = x.T @ d_h, d_h.sum(axis=0)
        for k, g in grad.items():
            g = g + DECAY * w[k] * (k in ("We", "V", "U")) / 10
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            w[k] = (w[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return Model(w)


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in text_slices(batches, "text"):
        x, owner = encode_passages(piece.column("text"))
        place, which = pa.array(np.arange(len(owner)) - np.searchsorted(owner, owner)), pa.array(owner)
        rows = pa.array([r.tobytes() for r in x.astype(np.float16)], pa.binary())
        yield pa.RecordBatch.from_arrays([piece.column("doc_id").take(which), piece.column("label").take(which), place, rows], names=["doc_id", "label", "place", "x"])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", per_class: int = PER_CLASS) -> Model:
    """Train on up to per_class documents of each label, the smallest by a hash of their id. labels: only rows that may be
    learnt from."""
    small_batches(docs.sparkSession)
    known = labels.where(f"{id_col} is not null and {label_col} is not null").groupBy(F.col(id_col).alias("doc_id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("label"))
    chosen = hash_sample(known, "label", "doc_id", per_class)
    rows = one_text(docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")), chosen, "label", "doc_id", "text")
    kind = docs.schema[id_col].dataType.simpleString()
    got = rows.mapInArrow(_sample, f"doc_id {kind}, label int, place long, x binary").toArrow().sort_by([("doc_id", "ascending"), ("place", "ascending")])
    if not got.num_rows:
        return Model(None)
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float16).reshape(got.num_rows, -1).astype(np.float32)
    ids = got.column("doc_id").to_numpy()
    owner = np.cumsum(np.concatenate(([False], ids[1:] != ids[:-1])))
    y = got.column("label").to_numpy()[np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))]
    return train(x, owner, y.astype(np.float32))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, attention): every document's score, and the largest weight that one of its passages has."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for piece in text_slices(batches, "text"):
            x, owner = encode_passages(piece.column("text"))
            n = piece.num_rows
            top = np.full(n, np.nan)
            if model.weights is not None:
                f = _network(model.weights, x, owner, n)
                top = np.maximum.reduceat(f["attention"], f["starts"]).astype(np.float64)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(model.score(x, owner, n)), pa.array(top)], names=["doc_id", "score", "attention"])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double, attention double")


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", folds: int = 3, held_out: int = 1, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, held_out, score, predicted, attention); the model learns from ids outside the held-out fold only."""
    model = fit(docs, labels.where(crc_mod(id_col, folds) != held_out), label_col, id_col, text_col, per_class)
    return score(docs, model, id_col, text_col).select(
        "doc_id", (crc_mod("doc_id", folds) == held_out).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "attention"
    )
