"""The registered queries of the operators in this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.llm import ann, chat_format, html_extract, langid, mixture, passages, pieces, quality_rules, secrets, simhash
from lattica.llm.common import read_table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", planted), (-1, 1, "assistant", planted)], "conv_id long, turn long, role string, text string")
    return chat_format.digest(chat_format.format_conversations(rows.union(more)))


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_hnsw_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "embeddings")
    return ann.search(ann.build_index(table), table.where("vec_id % 100 = 0"), k=10)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(read_table(spark, sf_dir, "documents")))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(read_table(spark, sf_dir, "documents"))


def op9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the cap of 3 a document has three copies at most."""
    planned = mixture.plan(read_table(spark, sf_dir, "documents"))
    at = lambda i: F.round(F.get("positions", F.lit(i)), 9)
    return planned.select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), "copies", "taken", at(0).alias("first_position"),
        *[at(i).alias(f"position_{i + 1}") for i in (1, 2)], *[F.get("ranks", F.lit(i)).alias(f"rank_{i + 1}") for i in range(3)],
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.classify(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_quality_rules, op3_chat_format, op4_simhash_dedup, op5_hnsw_search, op6_secret_scan,
        op7_html_extraction, op8_sentencepiece, op9_mixture, op10_language_id,
    )
}

_WORD = r"[^\x20\x09-\x0D]+"
_BLANK = "chr(32) || chr(9) || chr(11) || chr(12) || chr(13)"
_QUOTED = lambda pattern: pattern.replace("'", "''")


def _matches(name: str, pattern: str, kind: str, keep: str = "true") -> str:
    """(rid, start, kind, end) of a pattern's matches: gaps and hits side by side, their lengths summed up. hit_lead: code points
    of a match before its span."""
    lead = "case when regexp_matches(hit, '^[^A-Za-z]') then 1 else 0 end" if name == "identifier" else "0"
    return f"""
{name}_raw as (select rid, string_split_regex(text, '{_QUOTED(pattern)}') as gaps, regexp_extract_all(text, '{_QUOTED(pattern)}') as hits from texts where regexp_matches(text, '{_QUOTED(pattern)}')),
{name}_each as (select rid, unnest(range(1, len(hits) + 1)) as i, unnest(hits) as hit, unnest(gaps[:len(hits)]) as gap from {name}_raw),
{name}_at as (select *, sum(length(gap) + length(hit)) over (partition by rid order by i) as stop from {name}_each),
{name} as (select rid, (stop - length(hit) + {lead})::bigint as start, {kind} as kind, stop::bigint as stop from {name}_at where {keep})"""


_VALUE_CHARS = f"length(regexp_extract(hit, '{_QUOTED(secrets.ASSIGN)}', 2))"

ORACLES: dict[str, str] = {
    "op2_quality_rules": rf"""
with texts as (
    select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents
), words as (
    select rid, regexp_extract_all(text, '{_WORD}') as w from texts
), grams as (
    select rid, unnest(range(1, len(w) - 6)) as spot, w from words where len(w) >= 8
), twice as (
    select rid, unnest(list(spot)) as spot from (select rid, spot, array_to_string(w[spot:spot + 7], ' ') as gram from grams) group by rid, gram having count(*) > 1
), covered as (
    select rid, count(distinct place) as n from (select rid, unnest(range(spot, spot + 8)) as place from twice) group by rid
), lines as (
    select rid, unnest(string_split(text, chr(10))) as line from texts
), bodies as (
    select rid, line, trim(line, {_BLANK}) as body from lines
), told as (
    select rid, line, body, length(body) as n, strlen(body) as bytes, len(regexp_extract_all(body, '{_WORD}')) as n_words,
        length(body) - length(regexp_replace(body, '{_QUOTED(quality_rules.PHRASES.pattern)}', '', 'gi')) as phrases,
        len(regexp_extract_all(regexp_replace(body, '{_QUOTED(quality_rules.PHRASES.pattern)}', ' ', 'gi'), '{_WORD}')) as others,
        len(regexp_extract_all(body || ' ', '{quality_rules.SEPARATORS.pattern}')) as joints,
        length(body) - length(translate(body, '{quality_rules.MARKS.decode()}', '')) as marks,
        length(regexp_replace(body, '[A-Za-z\x20]|[^\x00-\x7F]', '', 'g')) as unlettered, length(body) - length(translate(body, '!?', '')) as shouts
    from bodies
), judged as (
    select rid, line, body, n, n > 0 and (
        (regexp_matches(body, '{_QUOTED(quality_rules.BOILERPLATE.pattern)}', 'i') and (2 * phrases >= n or (others <= {quality_rules.FURTHER_WORDS} and right(body, 1) not in ('.', '!', '?'))))
        or (joints >= 2 and joints * 6 >= n_words) or marks * 10 > bytes or (bytes >= 8 and unlettered * 2 > bytes) or (shouts >= 3 and shouts * 3 >= n_words)
        or (n_words >= 6 and upper(body) = body and lower(body) <> body)
    ) as removed from told
), shares as (
    select rid, sum(n) as before, sum(case when removed then 0 else n end) as after,
        count(case when n > 0 then 1 end) - count(distinct case when n > 0 then line end) as n_dup_lines
    from judged group by rid
), counted as (
    select t.rid, doc_id, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
        (length(text) - length(translate(text, '{quality_rules.SYMBOLS.decode()}', '')))::bigint as n_symbols, coalesce(c.n, 0)::bigint as n_repeat_words
    from texts t join words using (rid) left join covered c using (rid)
), based as (
    select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
        case when before > 0 then after::double / before::double else 1.0::double end as kept_share
    from counted join shares using (rid)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines::bigint as n_dup_lines, n_repeat_words, base_failed, kept_share,
    not base_failed and kept_share >= {quality_rules.MIN_KEPT} as kept
from based""",
    "op5_hnsw_search": """
with usable as (
    select distinct vec_id, embedding::double[] as v from embeddings
    where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs as (
    select q.vec_id as query_id, c.vec_id, sqrt(list_sum(list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) as score
    from usable q join usable c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 100 = 0
), ranked as (
    select query_id, row_number() over (partition by query_id order by score, vec_id) as rank, vec_id, score from pairs
)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 10""",
    "op6_secret_scan": f"""
with texts as (
    select row_number() over () as rid, doc_id, translate(coalesce(text, ''), chr(1) || chr(2), chr(3) || chr(3)) as text from documents
), {_matches("assign", secrets.ASSIGN, f"case when {_VALUE_CHARS} >= {secrets.ASSIGN_LEAST} then 0 else 4 end", f"{_VALUE_CHARS} >= {secrets.WEAK_LEAST}")},
{_matches("access", secrets.ACCESS, "1")},
{_matches("hexa", secrets.HEX, "2")},
{_matches("identifier", secrets.IDENTIFIER, "3")},
{_matches("bare", secrets.RUN_OF_KEY, "4", f"length(hit) = {secrets.KEY_LENGTH} and not regexp_matches(hit, '[=_-]')")},
{_matches("endpoint", secrets.ENDPOINT, "5")},
parts as (
    select *, ({list(secrets.ROLES)})[kind + 1] as role from (
        from assign union all from access union all from hexa union all from identifier union all from bare union all from endpoint)
), linked as (
    select w.rid, w.start, w.kind, w.stop from parts w join parts o on o.rid = w.rid and o.role <> w.role and o.start < w.stop + {secrets.SCOPE} and o.stop > w.start - {secrets.SCOPE}
    where w.kind >= {secrets.STRONG} group by all having bool_or(o.kind < {secrets.STRONG}) or min(o.role) <> max(o.role)
), spans as (
    select rid, start, kind, stop from parts where kind < {secrets.STRONG} union all from linked
), named as (
    select *, ({list(secrets.KINDS)})[kind + 1] || ':' || start || ':' || stop as told from spans
), told as (
    select rid, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex,
        string_agg(told, ',' order by start, kind, stop) filter (kind < {secrets.STRONG}) as base, string_agg(told, ',' order by start, kind, stop) as spans
    from named group by rid
)
select doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access, coalesce(n_hex, 0)::bigint as n_hex,
    sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from texts left join told using (rid)""",
    "op3_chat_format": r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked as (
    select *, case when lag(role) over w is distinct from role then 1 else 0 end as opens,
        length(regexp_replace(text, '([\\<\[])', '\1\\', 'g')) as text_chars,
        length(regexp_replace(role, '([\\<\[])', '\1\\', 'g')) as role_chars
    from turns window w as (partition by conv_id order by turn, role, text)
)
select conv_id, count(*)::bigint as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
    sum(text_chars + case when opens = 1 then length('<|start|><|text|><|end|>') + role_chars else length('<|join|>') end)::bigint as formatted_chars
from marked group by conv_id""",
    # the article of these tables' pages, by their markup
    "op7_html_extraction": r"""
with bodies as (
    select page_id, url, regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '<article>(.*?)(?:</article>|<footer>|$)', 1, 's'), '</?b>', '', 'g'), '<br>', ' ', 'g') as body from pages
), cut as (
    select page_id, url, list_transform(string_split_regex(body, '</?(?:p|h1)>'), lambda b: trim(regexp_replace(
        replace(replace(replace(replace(replace(b, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;', '&'), '\s+', ' ', 'g'))) as blocks from bodies
), joined as (
    select page_id, url, coalesce(array_to_string(list_filter(blocks, lambda b: b <> ''), chr(10) || chr(10)), '') as text from cut
)
select page_id, url, text, length(text)::bigint as n_chars from joined""",
    "op9_mixture": rf"""
with sized as (
    select doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::bigint as size,
        md5('mix:' || coalesce(doc_id::varchar, '')) as ord
    from documents
), totals as (
    select source, sum(size)::bigint as source_size, (row_number() over (order by source nulls last) - 1) % 3 as place from sized group by source
), weighed as (
    select source, source_size, case place when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as weight,
        case place when 0 then -0.5::double when 1 then 0.0::double else 0.5::double end as slope, source_size * 3.0::double as most
    from totals
), levels as (
    select *, most / weight as ratio,
        (sum(source_size::double) over () - coalesce(sum(most) over (o rows between unbounded preceding and 1 preceding), 0.0))
        / sum(weight) over (o rows between current row and unbounded following) as level
    from weighed window o as (order by most / weight, source nulls first)
), goals as (
    select *, coalesce(least(most, max(case when level < ratio then level end) over () * weight), most) as target from levels
), laid as (
    select s.*, g.source_size, g.target, g.slope,
        coalesce(sum(s.size) over (partition by s.source order by s.ord, s.doc_id, s.size rows between unbounded preceding and 1 preceding), 0)::bigint as start
    from sized s join goals g on s.source is not distinct from g.source
), taken as (
    select *, case when source_size > 0 then floor(target / source_size) else 0 end as passes from laid
), copied as (
    select *, (passes + case when start + size / 2.0::double < target - passes * source_size then 1 else 0 end)::bigint as copies from taken
), places as (
    select *, unnest(range(0, copies)) as copy from copied
), timed as (
    select *, case when target > 0 then least((copy * source_size + start + size / 2.0::double) / target, 1.0) else 0.0 end as asked from places
), positioned as (
    select *, 2 * asked / ((1 - slope) + sqrt((1 - slope) * (1 - slope) + 4 * slope * asked)) as position from timed
), ranked as (
    select *, row_number() over (order by position, doc_id nulls first, copy) - 1 as rank from positioned
), told as (
    select doc_id, source, size, start, max(position) filter (copy = 0) as p1, max(position) filter (copy = 1) as p2, max(position) filter (copy = 2) as p3,
        max(rank) filter (copy = 0) as r1, max(rank) filter (copy = 1) as r2, max(rank) filter (copy = 2) as r3
    from ranked group by doc_id, source, size, start
)
select c.doc_id, c.size, c.source_size, round(c.target, 6) as target, c.copies, c.copies * c.size as taken, round(p1, 9) as first_position,
    round(p2, 9) as position_2, round(p3, 9) as position_3, r1 as rank_1, r2 as rank_2, r3 as rank_3
from copied c left join told t on c.doc_id is not distinct from t.doc_id and c.source is not distinct from t.source and c.size = t.size and c.start = t.start""",
}
