"""Quality rules: line-first cleaning.

Every line is judged on its own by punctuation, navigation and boilerplate rules; lines that fail are removed, and a
document that loses too much of its text is rejected. Base rules on the whole text (too few words, too much of it inside
repeated eight-word windows) reject on their own.

Defined results: a null or empty text has no words, so every count is 0, base_failed is true and kept is false; its
cleaned text is empty. Rows are judged one by one, so repeated rows and null ids give one result each. Only the id and text
columns are read; the other columns of the input pass through `clean` untouched, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import small_batches, text_slices
from lattica.llm.textkernel import SPACE, Texts, repeats, windows

#: Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
#: Phrases that a boilerplate line begins with and is mostly made of, by language.
PHRASE = {
    "en": r"all rights reserved|copyright\b|©|\(c\) \d{4}|terms (of use|of service|and conditions)|privacy policy|cookie policy|legal notice"
    r"|this (site|website|page) uses cookies|we use cookies|accept (all )?cookies|enable javascript|javascript (is|must be)"
    r"|sign (in|up)\b|log ?in\b|subscribe\b|share (this|on)\b|follow us\b|skip to (main )?content|back to top|read more\b"
    r"|click here\b|powered by\b|lorem ipsum",
    "de": r"alle rechte vorbehalten|impressum\b|datenschutz(erkl[äÄ]rung)?\b|nutzungsbedingungen|cookie-richtlinie|wir verwenden cookies"
    r"|(alle )?cookies akzeptieren|anmelden\b|registrieren\b|newsletter abonnieren|jetzt teilen|folgen sie uns|zum (haupt)?inhalt springen"
    r"|nach oben\b|weiterlesen\b|mehr lesen\b|hier klicken",
    "fr": r"tous droits r[éÉ]serv[éÉ]s|mentions l[éÉ]gales|politique de (confidentialit[éÉ]|cookies)|conditions d['’]utilisation"
    r"|(nous utilisons|accepter) (des|les) cookies|se connecter\b|s['’](inscrire|abonner)\b|partager (cet|sur)\b|suivez-nous\b"
    r"|aller au contenu|haut de page|lire la suite|cliquez ici",
    "es": r"todos los derechos reservados|aviso legal|pol[íÍ]tica de (privacidad|cookies)|t[éÉ]rminos y condiciones|condiciones de uso"
    r"|(usamos|utilizamos|aceptar) (las )?cookies|iniciar sesi[óÓ]n|reg[íÍ]strate|suscr[íÍ]bete|comparte (esto|en)\b|s[íÍ]guenos\b"
    r"|saltar al contenido|volver arriba|leer m[áÁ]s|haz clic aqu[íÍ]",
}
_PHRASES = "|".join(PHRASE.values())
BOILERPLATE = re.compile(rf"^\W*({_PHRASES})", re.IGNORECASE | re.ASCII)
PHRASES = re.compile(rf"({_PHRASES})|\b\d{{4}}\b", re.IGNORECASE | re.ASCII)
#: Further words that a line may have besides its phrases if it isn't a sentence.
FURTHER_WORDS = 3
#: Navigation: short items joined by separators.
SEPARATORS = re.compile(r"[\x20\x09-\x0D][|»›>•·/][\x20\x09-\x0D]")
BLANK = " \t\n\v\f\r"

#: Bytes that prose has few of; bytes that are letters or part of a character beyond ASCII, or spaces between them.
MARKS = b"#*$%&|<>=~^_{}\\"
LETTERS = bytes([0x20, *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])

MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
#: A document must keep this share of the characters of its lines.
MIN_KEPT = 0.5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def is_boilerplate(body: str) -> bool:
    """It begins with a phrase, and its phrases and years hold half of it, or few words follow that aren't a sentence's."""
    if not BOILERPLATE.match(body):
        return False
    if 2 * sum(m.end() - m.start() for m in PHRASES.finditer(body)) >= len(body):
        return True
    return body[-1] not in ".!?" and len(PHRASES.sub(" ", body).encode().split()) <= FURTHER_WORDS


def line_verdict(line: str) -> str | None:
    """The rule that removes this line, or None to keep it."""
    body = line.strip(BLANK)
    if not body:
        return None
    if is_boilerplate(body):
        return "boilerplate"
    raw = body.encode()
    words = raw.split()
    joints = len(SEPARATORS.findall(f"{body} "))
    if joints >= 2 and joints * 6 >= len(words):
        return "navigation"
    if (len(raw) - len(raw.translate(None, MARKS))) * 10 > len(raw):
        return "punctuation"
    if len(raw) >= 8 and len(raw.translate(None, LETTERS)) * 2 > len(raw):
        return "punctuation"
    marks = body.count("!") + body.count("?")
    if marks >= 3 and marks * 3 >= len(words):
        return "punctuation"
    if len(words) >= 6 and body.upper() == body and body.lower() != body:
        return "punctuation"
    return None


def clean_text(text: str) -> tuple[str, float]:
    """The lines that pass, and the share of the lines' characters that they hold (1 for a text without any)."""
    kept, before, after = [], 0, 0
    for line in text.split("\n"):
        n = len(line.strip(BLANK))
        before += n
        if line_verdict(line) is None:
            kept.append(line)
            after += n
    return "\n".join(kept), after / before if before else 1.0


def base_counts(column: pa.Array) -> dict[str, np.ndarray]:
    """The base counts of each text."""
    texts = Texts.of(column)
    data, n = texts.data, len(texts)
    word = ~SPACE[data]
    s, e, owner = texts.runs(word)
    out = {"n_words": np.bincount(owner, minlength=n), "word_chars": texts.counts(word & ((data & 0xC0) != 0x80))}
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    out["n_symbols"] = texts.counts(symbol[data])
    ls, le, lo = texts.runs(data != 0x0A)
    worded = np.zeros(len(data) + 1, np.int64)
    np.cumsum(word, out=worded[1:])
    has = worded[le] > worded[ls]
    ls, le, lo = ls[has], le[has], lo[has]
    _, later = repeats(windows(texts.hashes(ls, le), lo, 1)[1])
    out["n_dup_lines"] = np.bincount(lo[later], minlength=n)
    at, keys = windows(texts.hashes(s, e), owner, 8)
    twice, _ = repeats(keys)
    cover = np.zeros(len(s) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + 8, -1)
    out["n_repeat_words"] = np.bincount(owner[np.cumsum(cover[:-1]) > 0], minlength=n)
    return out


def _judge(batches: Iterator[pa.RecordBatch], text: str, keep: tuple[str, ...], with_text: bool, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for piece in text_slices(batches, text):
        counts = base_counts(piece.column(text))
        failed = (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEATED_PERCENT * counts["n_words"])
        cleaned = [clean_text(x or "") for x in piece.column(text).to_pylist()]
        share = np.array([x[1] for x in cleaned])
        out = {c: piece.column(c) for c in keep} | counts | {"base_failed": failed, "kept_share": share, "kept": ~failed & (share >= MIN_KEPT)}
        if with_text:
            out["clean_text"] = [x[0] for x in cleaned]
        yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) if not isinstance(out[f.name], pa.Array) else out[f.name] for f in schema], schema=schema)


def _fields(with_text: bool) -> list[pa.Field]:
    out = [pa.field(c, pa.int64()) for c in COUNTS]
    out += [pa.field("base_failed", pa.bool_()), pa.field("kept_share", pa.float64()), pa.field("kept", pa.bool_())]
    return out + [pa.field("clean_text", pa.string())] * with_text


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per document: its id, the base counts, base_failed, the share of text that its passing lines hold, and
    kept; with_text adds the passing lines."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = pa.schema([pa.field("doc_id", pa.int64()), *_fields(with_text)])
    ddl = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept_share double, kept boolean" + ", clean_text string" * with_text
    return rows.mapInArrow(partial(_judge, text="text", keep=("doc_id",), with_text=with_text, schema=schema), ddl)


def clean(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that are kept, in the columns they came with, their text reduced to the lines that pass."""
    small_batches(docs.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = _fields(True)
        for piece in text_slices(batches, text_col):
            only = pa.RecordBatch.from_arrays([piece.column(text_col)], names=["text"])
            for verdict in _judge(iter([only]), "text", (), True, pa.schema(fields)):
                at = piece.schema.get_field_index(text_col)
                new = piece.set_column(at, piece.schema.field(at), verdict.column("clean_text").cast(piece.schema.field(at).type))
                yield new.filter(verdict.column("kept"))

    return docs.mapInArrow(run, docs.schema)
