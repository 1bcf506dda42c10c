"""Language identification with bit-sliced Bloom filters over byte n-grams.

One table serves all languages: row h is a mask with a bit per language, set if an n-gram of that language hashes to h. The
AND of an n-gram's rows is the set of all languages that contain it (or, seldom, a false positive), in as many look-ups as
one language alone would take. Per language the popcount over a text's n-grams, less the false positives expected from the
filter's fill, decides.

A language contains an n-gram if one in RARE of its sampled documents has it (one at least), whatever other languages have;
every such n-gram goes into the table. The sample is up to `per_lang` documents of each language, the smallest by a hash of
doc_id; copies of a row are one document.

Defined results: a null text or one without a letter is `und` with score 0; rows without a doc_id or lang aren't learnt
from but are predicted; repeated rows get equal results; with nothing to learn from everything is `und`; ties go to the
language that sorts first; an empty table gives an empty result. Only the columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import checkpoint, crc_mod, hash_sample, one_text, small_batches, text_slices

ORDERS = (2, 3, 4)
PER_LANG = 400
RARE = 100
HASHES = 3
#: Rows of the filter per n-gram of the language with most; a power of two is taken.
ROWS_PER_GRAM = 12

#: ASCII letters stay, other ASCII becomes a space; bytes of characters beyond ASCII stay.
_LETTER = np.full(256, 0x20, np.uint8)
_LETTER[list(range(0x61, 0x7B))] = list(range(0x61, 0x7B))
_LETTER[list(range(0x80, 0x100))] = list(range(0x80, 0x100))
_MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0xD6E8FEB86659FD93))


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of all texts as UTF-8, runs of anything else as one space, a space at both ends; offsets."""
    raw = [b" " + x.lower().encode() + b" " for x in texts]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in raw])))
    data = _LETTER[np.frombuffer(b"".join(raw), np.uint8)]
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != 0x20) | (data[:-1] != 0x20)
    keep[offsets[:-1]] = True
    kept = np.concatenate(([0], np.cumsum(keep)))
    return data[keep], kept[offsets]


def grams(data: np.ndarray, order: int) -> np.ndarray:
    """The n-gram at every place, as a number that also tells its order; the last order - 1 places are left out."""
    n = max(0, len(data) - order + 1)
    out = np.full(n, order << 32, np.uint64)
    for i in range(order):
        out |= data[i : i + n].astype(np.uint64) << np.uint64(8 * i)
    return out


@dataclass
class Filters:
    languages: list[str]
    rows: np.ndarray  # (rows, words): with b bits a word, bit l % b of word l // b belongs to language l

    @property
    def bits(self) -> int:
        return 8 * self.rows.itemsize

    def places(self, gram: np.ndarray) -> list[np.ndarray]:
        shift = np.uint64(64 - (len(self.rows) - 1).bit_length())
        return [((gram * m) >> shift).astype(np.int64) for m in _MULTIPLIERS[:HASHES]]

    @classmethod
    def build(cls, languages: list[str], gram: np.ndarray, language: np.ndarray) -> Filters:
        most = int(np.bincount(language, minlength=1).max()) if len(language) else 1
        word = next((t for t in (np.uint8, np.uint16, np.uint32) if len(languages) <= 8 * np.dtype(t).itemsize), np.uint64)
        bits = 8 * np.dtype(word).itemsize
        out = cls(languages, np.zeros((1 << max(10, (most * ROWS_PER_GRAM - 1).bit_length()), -(-max(1, len(languages)) // bits)), word))
        bit = (np.uint64(1) << (language % bits).astype(np.uint64)).astype(word)
        for at in out.places(gram):
            np.bitwise_or.at(out.rows, (at, language // bits), bit)
        return out

    def _has(self, mask: np.ndarray, i: int) -> np.ndarray:
        return (mask >> mask.dtype.type(i % self.bits)) & mask.dtype.type(1)

    def false_positive(self) -> np.ndarray:
        """Per language, the chance that an n-gram it doesn't have passes."""
        n = len(self.languages)
        fill = [float(self._has(self.rows[:, i // self.bits], i).mean()) for i in range(n)]
        return np.array(fill) ** HASHES

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per text and language, how many n-grams pass; per text, how many there are."""
        n, total = len(offsets) - 1, np.zeros(len(offsets) - 1)
        out = np.zeros((n, len(self.languages)))
        for order in ORDERS:
            first, last = offsets[:-1], np.maximum(offsets[:-1], offsets[1:] - order + 1)
            places = self.places(grams(data, order))
            total += last - first
            for word in range(self.rows.shape[1]):
                column = np.ascontiguousarray(self.rows[:, word])
                mask = column[places[0]]
                for at in places[1:]:
                    mask &= column[at]
                for i in range(self.bits * word, min(len(self.languages), self.bits * (word + 1))):
                    passed = np.concatenate(([0], np.cumsum(self._has(mask, i), dtype=np.int64)))
                    out[:, i] += passed[last] - passed[first]
        return out, total

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not texts:
            return [], np.zeros(0)
        has_letter = np.array([any(map(str.isalpha, x)) for x in texts])
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        passed, total = self.counts(*letters(texts))
        chance = self.false_positive()
        corrected = np.maximum(0, (passed - total[:, None] * chance) / np.maximum(1e-9, 1 - chance))
        best = corrected.argmax(axis=1)
        score = (corrected[np.arange(len(best)), best] + 1 / len(self.languages)) / (corrected.sum(axis=1) + 1)
        return [self.languages[i] if ok else "und" for i, ok in zip(best, has_letter, strict=True)], np.where(has_letter, score, 0.0)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n): how many texts of a language have each n-gram."""
    for piece in text_slices(batches, "text"):
        languages = np.array([str(x) for x in piece.column("lang").to_pylist()])
        texts = piece.column("text").to_pylist()
        for language in np.unique(languages):
            data, offsets = letters([x or "" for x, y in zip(texts, languages, strict=True) if y == language])
            text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            for order in ORDERS:
                gram = grams(data, order)
                inside = text[: len(gram)] == text[order - 1 :]
                gram, owner = gram[inside], text[: len(gram)][inside]
                at = np.lexsort((owner, gram))
                gram, owner = gram[at], owner[at]
                new = np.ones(len(gram), bool)
                new[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
                gram, n = np.unique(gram[new], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([str(language)] * len(gram), pa.string()), pa.array(gram.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = PER_LANG) -> Filters:
    """docs: only rows that may be learnt from. What reaches the driver are the n-grams of the sampled documents."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang")).where("doc_id is not null and lang is not null and text is not null")
    chosen = hash_sample(rows.select("lang", "doc_id"), "lang", "doc_id", per_lang)
    sample = checkpoint(one_text(rows, chosen, "lang", "doc_id", "text"))
    least = sample.groupBy("lang").agg(F.greatest(F.lit(1), F.round(F.count("*") / RARE)).alias("least"))
    counted = sample.select("lang", "text").mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    got = counted.join(F.broadcast(least), "lang").where("n >= least").select("lang", "gram").toArrow()
    languages = sorted(set(got.column("lang").to_pylist()))
    number = {x: i for i, x in enumerate(languages)}
    return Filters.build(languages, got.column("gram").to_numpy().astype(np.uint64), np.array([number[x] for x in got.column("lang").to_pylist()], np.int64))


def identify(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every text."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches, "text"):
            names, score = shared.value.predict([x or "" for x in piece.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5, held_out: int = 0, per_lang: int = PER_LANG) -> DataFrame:
    """(doc_id, held_out, lang_pred, score); learns from ids outside the held-out fold only."""
    filters = fit(docs.where(crc_mod(id_col, folds) != held_out), id_col, text_col, lang_col, per_lang)
    return identify(docs, filters, id_col, text_col).select("doc_id", (crc_mod("doc_id", folds) == held_out).alias("held_out"), "lang_pred", "score")
