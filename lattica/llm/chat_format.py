"""Relational chat formatting, in Spark expressions only.

A conversation's turns are collected as structs, sorted by turn (then role and text), and neighbours of one role are merged
into one block. The template marks blocks and turns with control strings,

    <|start|>role<|text|>text<|join|>text<|end|>

and a backslash goes after every backslash, `<` and `[` inside roles and texts, so that neither the template's control
strings nor others (`</s>`, `[INST]`) can stand in the output unless the template wrote them; removing those backslashes
from left to right gives the texts back exactly. The loss mask covers the escaped texts of the chosen roles; it is kept as
runs (chars, loss) that tile the output, a run for each control string, role and text that isn't empty.

All steps are linear in a conversation: what several lambdas need is bound once, and the output is cut at its control strings
and laid beside the mask's runs, so that no string grows and no place is searched for from the start.

Defined results: a null role or text counts as empty; rows without a conv_id form one conversation of their own; repeated
rows are turns of their own; an empty table gives an empty result. Only the four columns named are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import let

START, TEXT, JOIN, END = "<|start|>", "<|text|>", "<|join|>", "<|end|>"
LOSS_ROLES = ("assistant",)


def _literal(control: str) -> str:
    """The regular expression for a control string."""
    return control.replace("|", r"\|")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])\\", "$1")


def merged_blocks(turns: Column) -> Column:
    """array<struct<role, texts>> of sorted turns: the place where each block starts, then the slice up to the next."""
    opens = lambda t, i: (i == 0) | (F.get(t, i)["role"] != F.get(t, i - 1)["role"])

    def blocks(t: Column, starts: Column) -> Column:
        def one(s: Column, k: Column) -> Column:
            own = F.slice(t, s + 1, F.coalesce(F.get(starts, k + 1), F.size(t)) - s)
            return F.struct(F.get(t, s)["role"].alias("role"), F.transform(own, lambda x: x["text"]).alias("texts"))

        return F.transform(starts, one)

    return let(turns, lambda t: let(F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda i: opens(t, i)), lambda starts: blocks(t, starts)))


def format_conversations(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", loss_roles: tuple[str, ...] = LOSS_ROLES
) -> DataFrame:
    """(conv_id, formatted, mask): one row per conversation; mask is array<struct<chars, loss>>."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    one = F.struct(F.col(turn).alias("turn"), filled(role).alias("role"), filled(text).alias("text"))
    got = rows.select(F.col(conv).alias("conv_id"), one.alias("one")).groupBy("conv_id").agg(F.array_sort(F.collect_list("one")).alias("turns"))
    got = got.select("conv_id", merged_blocks(F.col("turns")).alias("blocks"))

    def runs(block: Column) -> Column:
        """The pieces of a block, each with its place in the loss mask."""
        piece = lambda s, loss: F.struct(s.alias("piece"), loss.alias("loss"))
        plain = lambda control: piece(F.lit(control), F.lit(False))
        own = block["role"].isin(*loss_roles)
        body = F.transform(block["texts"], lambda t, i: F.array(piece(F.when(i > 0, F.lit(JOIN)).otherwise(F.lit("")), F.lit(False)), piece(escape(t), own)))
        return F.concat(F.array(plain(START), piece(escape(block["role"]), F.lit(False)), plain(TEXT)), F.flatten(body), F.array(plain(END)))

    got = got.select("conv_id", F.flatten(F.transform("blocks", runs)).alias("pieces"))
    mask = F.transform("pieces", lambda p: F.struct(F.length(p["piece"]).cast("long").alias("chars"), p["loss"].alias("loss")))
    return got.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"),
        F.filter(mask, lambda m: m["chars"] > 0).alias("mask"),
    )


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>>: the turns, read back from the formatted string."""

    def turns(halves: Column) -> Column:
        body = F.regexp_replace(F.get(halves, F.lit(1)), rf"{_literal(END)}$", "")
        own = lambda role: F.transform(F.split(body, _literal(JOIN), -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))
        return let(unescape(F.get(halves, F.lit(0))), own)

    blocks = F.split(formatted, _literal(START), -1)
    blocks = let(blocks, lambda b: F.slice(b, F.lit(2), F.greatest(F.size(b) - 1, F.lit(0))))
    return F.flatten(F.transform(blocks, lambda b: let(F.split(b, _literal(TEXT), 2), turns)))


def loss_text(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between. A mask whose runs aren't those of the output is an error."""
    control = "|".join(map(_literal, (START, TEXT, JOIN, END)))
    pieces = F.filter(F.split(formatted, f"(?<={control})|(?={control})", -1), lambda p: p != "")

    def under(runs: Column) -> Column:
        fits = F.forall(runs, lambda r: F.coalesce(F.length(r["piece"]) == r["run"]["chars"], F.lit(False)))
        text = F.array_join(F.transform(F.filter(runs, lambda r: r["run"]["loss"]), lambda r: r["piece"]), "")
        return F.when(fits, text).otherwise(F.raise_error(F.lit("the mask doesn't fit the text")))

    return unescape(let(F.arrays_zip(pieces.alias("piece"), mask.alias("run")), under))


def digest(formatted: DataFrame) -> DataFrame:
    """Figures read back from the output of format_conversations."""
    got = formatted.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), loss_text(F.col("formatted"), F.col("mask")).alias("loss"))
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return got.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
