r"""Secret scan with multipart credential linking, in DataFrame functions only.

Base kinds are strong parts, always reported: `assign` (a keyword, `:` or `=`, and a value of 8 or more characters),
`access` (an AKIA identifier of 16 or more) and `hex` (32 or more hex digits); per kind the leftmost non-overlapping matches.
Weak parts mean little alone: `identifier` (a user, account or client name), `key` (a bare token of 40 base64 characters,
or a short assigned value) and `endpoint` (a URL). Parts play three roles: identifier, secret, endpoint.

The parts of a document are interval-joined with each other within a scope of SCOPE code points around each weak part, as an
equi-join on (document, bin of SCOPE code points) plus the exact overlap test. A weak part is reported only if, within its
scope, a strong part of another role occurs, or weak parts of both other roles. Parts of one kind don't overlap, so a bin
holds a bounded number of them, and the join stays linear in the text.

Spans are code points, end exclusive. One pass of a regular expression marks its matches, a cut at the marks gives matches and
gaps, and their running lengths give the places. All steps are linear in the text and in its spans.

Defined results: a null text counts as empty and has no spans; repeated rows give repeated results; null ids are kept; an
empty table gives an empty result. Only the id and text columns are read; `redact` passes the others through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import checkpoint, fresh, let, running

SCOPE = 200
MARK = "[SECRET]"

# The base patterns and their least lengths.
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST, WEAK_LEAST = 8, 4
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"


def _any_case(words: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if "a" <= c <= "z" else c for c in words)


# The method's weak patterns; an identifier's keyword stands behind no other letter, a key is a whole run of its characters.
IDENTIFIER = rf"""(^|[^A-Za-z])((?:{"|".join(map(_any_case, ("user(?:_?name)?", "login", "account(?:_?id)?", "client_?id", "access_?key_?id")))})["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{{3,}})"""
RUN_OF_KEY = r"[A-Za-z0-9/+=_-]{40,}"
KEY_LENGTH = 40
ENDPOINT = r"[a-z][a-z0-9+]{1,9}://[^\x20\x09-\x0D\"'<>]+"
#: A text without such a run has no hex digits and no key to report.
LONG, LONG_RUN = 32, r"[A-Za-z0-9/+=_-]{32,}"
#: Marks around a match and before its value; a text's own are read as the third.
MARK_ENDS, MARK_VALUE, MARK_NONE = "\x01", "\x02", "\x03"

#: Kinds in the order of the contract, then the method's; role 0 identifier, 1 secret, 2 endpoint.
KINDS = ("assign", "access", "hex", "identifier", "key", "endpoint")
ROLES = (1, 0, 1, 0, 1, 2)
STRONG = 3
SPAN = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: Column, pattern: str, marked: str, kind) -> Column:
    """Spans of the matches. marked: the match with its marks; kind: the kind of a marked match, null to drop it. A dropped match
    is matched all the same."""
    none = F.array().cast(SPAN)

    def places(pieces: Column) -> Column:
        lengths = F.transform(pieces, lambda p: F.length(p) - F.contains(p, F.lit(MARK_VALUE)).cast("int"))

        def spans(size: Column, at: Column) -> Column:
            hits = F.sequence(F.lit(1), F.size(pieces) - 2, F.lit(2))
            found = F.transform(hits, lambda i: F.struct(F.get(at, i).alias("start"), kind(F.get(pieces, i)).alias("kind"), (F.get(at, i) + F.get(size, i)).alias("end")))
            return F.filter(found, lambda s: s["kind"].isNotNull())

        return let(lengths, lambda size: let(running(size, "int", lambda a, b: a + b, F.lit(0)), lambda at: spans(size, at)))

    pieces = F.split(F.regexp_replace(text, F.lit(pattern), F.lit(marked)), MARK_ENDS, -1)
    return let(pieces, lambda p: F.when(F.size(p) > 1, places(p)).otherwise(none))


def _has_any(text: Column, words: tuple[str, ...]) -> Column:
    out = F.contains(text, F.lit(words[0]))
    for word in words[1:]:
        out |= F.contains(text, F.lit(word))
    return out


def _has_long_run(text: Column) -> Column:
    """A run holds no space, so texts without a long word between spaces, nearly all, aren't searched by the expression."""
    return F.exists(F.split(text, " "), lambda w: F.length(w) >= LONG) & text.rlike(LONG_RUN)


HINTS = ("user", "login", "account", "client", "access")


def may_report(text: Column) -> Column:
    """False only for texts without any span to report: an identifier alone is never reported."""
    return _has_any(F.lower(text), KEYWORDS) | _has_any(text, ("AKIA", "://")) | _has_long_run(text)


def parts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, k1, k2, parts): all parts of each document, strong and weak, in order; k1 and k2 name the row's content."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    raw = F.col("text")
    t = F.when(_has_any(raw, (MARK_ENDS, MARK_VALUE)), F.translate(raw, MARK_ENDS + MARK_VALUE, MARK_NONE * 2)).otherwise(raw)
    low = F.lower("text")
    none = F.array().cast(SPAN)
    whole = f"{MARK_ENDS}$0{MARK_ENDS}"
    one = lambda kind: lambda p: F.lit(kind)
    value = lambda p: F.length(F.substring_index(p, MARK_VALUE, -1))
    assigned = lambda p: F.when(value(p) >= ASSIGN_LEAST, 0).when(value(p) >= WEAK_LEAST, 4)
    bare = lambda p: F.when((F.length(p) == KEY_LENGTH) & ~p.rlike("[=_-]"), 4)
    tokens = F.concat(_spans(t, HEX, whole, one(2)), _spans(t, RUN_OF_KEY, whole, bare))
    found = [
        (_has_any(low, KEYWORDS), _spans(t, ASSIGN, f"{MARK_ENDS}$1{MARK_VALUE}$2{MARK_ENDS}", assigned)),
        (_has_any(raw, ("AKIA",)), _spans(t, ACCESS, whole, one(1))),
        (_has_long_run(raw), tokens),
        (_has_any(low, HINTS), _spans(t, IDENTIFIER, f"$1{MARK_ENDS}$2{MARK_ENDS}", one(3))),
        (_has_any(raw, ("://",)), _spans(t, ENDPOINT, whole, one(5))),
    ]
    every = F.array_sort(F.concat(*[F.when(test, spans).otherwise(none) for test, spans in found]))
    return rows.select("doc_id", F.xxhash64("doc_id", "text").alias("k1"), F.hash("text").alias("k2"), every.alias("parts"))


def link(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(k1, k2, linked): the weak parts of each document that are reported; documents without any are left out."""
    roles = F.array(*map(F.lit, ROLES))
    weak_or_more = found.where(F.exists("parts", lambda p: p["kind"] >= STRONG) & (F.size("parts") > 1)).dropDuplicates(["k1", "k2"])  # copies have equal links
    every = weak_or_more.select("k1", "k2", F.explode("parts").alias("p")).select(
        "k1", "k2", "p", F.get(roles, F.col("p.kind")).alias("role"), (F.col("p.kind") < STRONG).alias("strong")
    )
    bins = lambda a, b: F.explode(F.sequence(F.floor(a / scope), F.floor(b / scope)))
    weak = every.where("not strong").select("k1", "k2", "p", "role", bins(F.col("p.start") - scope, F.col("p.end") + scope - 1).alias("bin"))
    other = every.select("k1", "k2", F.col("p").alias("q"), F.col("role").alias("other_role"), "strong", bins(F.col("p.start"), F.col("p.end") - 1).alias("bin"))
    near = weak.join(other, ["k1", "k2", "bin"]).where(
        (F.col("role") != F.col("other_role")) & (F.col("q.start") < F.col("p.end") + scope) & (F.col("q.end") > F.col("p.start") - scope)
    )
    told = near.groupBy("k1", "k2", "p").agg(F.max("strong").alias("strong"), F.min("other_role").alias("low"), F.max("other_role").alias("high"))
    return told.where("strong or low <> high").groupBy("k1", "k2").agg(F.collect_list("p").alias("linked"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """(doc_id, k1, k2, base, spans): the base spans and all reported spans of each document, by start and kind."""
    found = checkpoint(parts(docs, id_col, text_col))
    got = found.join(link(found, scope), ["k1", "k2"], "left")
    base = F.filter("parts", lambda p: p["kind"] < STRONG)
    spans = F.array_sort(F.concat(base, F.coalesce("linked", F.array().cast(SPAN))))
    return got.select("doc_id", "k1", "k2", base.alias("base"), spans.alias("spans"))


def _joined(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"),
    )


#: Code points in one piece of a text that is being cut.
PIECE = 1024


def _cut_out(text: Column, spans: Column, mark: str) -> Column:
    """The text with the mark in place of each run of overlapping spans, which are sorted. It is first cut into pieces of PIECE
    code points, so that a place is found from its piece and not from the text's start."""

    def between(pieces: Column, a: Column, b: Column) -> Column:
        i, j = F.floor(a / PIECE).cast("int"), F.floor(b / PIECE).cast("int")
        part = lambda k, start, n: F.coalesce(F.substring(F.get(pieces, k), start + 1, n), F.lit(""))
        whole = F.array_join(F.slice(pieces, i + 2, F.greatest(j - i - 1, F.lit(0))), "")
        return F.when(i == j, part(i, a % PIECE, b - a)).otherwise(F.concat(part(i, a % PIECE, F.lit(PIECE)), whole, part(j, F.lit(0), b % PIECE)))

    def marked(pieces: Column, ends: Column) -> Column:
        placed = F.transform(spans, lambda s, i: F.struct(F.get(ends, i).alias("after"), s["start"].alias("start")))
        heads = F.filter(placed, lambda p: p["start"] >= p["after"])
        body = F.array_join(F.transform(heads, lambda p: F.concat(between(pieces, p["after"], p["start"]), F.lit(mark))), "")
        return F.concat(body, between(pieces, F.array_max(F.transform(spans, lambda s: s["end"])), F.length(text)))

    ends = running(F.transform(spans, lambda s: s["end"]), "int", lambda a, b: F.greatest(a, b), F.lit(0))
    return let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)), lambda pieces: let(ends, lambda e: marked(pieces, e)))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = MARK, scope: int = SCOPE) -> DataFrame:
    """The documents with every reported span replaced by the mark (overlapping spans by one), in the columns they came
    with. Documents that can't have one pass through where they are; only the others' texts are shuffled."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    some, rest = docs.where(may_report(text)), docs.where(~may_report(text))
    a, b, spans = fresh(docs, "k1", "k2", "spans")
    found = scan(some, id_col, text_col, scope).where(F.size("spans") > 0).dropDuplicates(["k1", "k2"]).select(F.col("k1").alias(a), F.col("k2").alias(b), F.col("spans").alias(spans))
    rows = some.withColumns({a: F.xxhash64(F.col(id_col), text), b: F.hash(text)}).join(found, [a, b], "left")
    done = rows.withColumn(text_col, F.when(F.col(spans).isNull(), F.col(text_col)).otherwise(_cut_out(text, F.col(spans), mark)))
    return rest.unionByName(done.select(*docs.columns))
