"""Catalog queries over the driver's tables: orders, documents, labels and the rest stand in for asset catalogs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.functions import scalars as S
from lattica.operators import catalog as C
from lattica.operators import sampling
from lattica.plans.registry import query, table
from lattica.streaming.incremental import event_windows, sessions

LAYERS = """
base as (select o_orderkey as key, o_orderstatus as status, o_custkey as cust from orders where o_orderkey % 3 <> 0),
lines as (select l_orderkey as key, case when max(l_linenumber) > 4 then 'F' end as status, count(*)::bigint as n_lines, sum(l_quantity::bigint)::bigint as qty from lineitem group by 1),
fixes as (select o_orderkey as key, case when o_orderkey % 2 = 0 then 'B' end as status, o_custkey * 10 as cust from orders where o_orderkey % 5 = 0)
"""


def _layers(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    orders = table(spark, sf, "orders")
    base = orders.where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("cust"))
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(
        F.when(F.max("l_linenumber") > 4, "F").alias("status"), F.count("*").alias("n_lines"), F.sum(F.col("l_quantity").cast("long")).alias("qty")
    )
    fixes = orders.where("o_orderkey % 5 = 0").select(F.col("o_orderkey").alias("key"), F.expr("case when o_orderkey % 2 = 0 then 'B' end").alias("status"), (F.col("o_custkey") * 10).alias("cust"))
    return base, lines, fixes


@query(f"with {LAYERS} select key, coalesce(b.status, l.status, f.status) as status, coalesce(b.cust, f.cust) as cust, n_lines, qty from base b full join lines l using (key) full join fixes f using (key)")
def overlay_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The base wins."""
    return C.overlay(_layers(spark, sf), "key")


@query(f"with {LAYERS} select key, coalesce(f.status, l.status, b.status) as status, coalesce(f.cust, b.cust) as cust, n_lines, qty from base b full join lines l using (key) full join fixes f using (key)")
def overlay_merge(spark: SparkSession, sf: str) -> DataFrame:
    """J1 as a record merge: the last part wins over the others and over the base."""
    base, lines, fixes = _layers(spark, sf)
    return C.merge_records(base, {"part_1": lines, "part_2": fixes}, "key")


@query(f"with {LAYERS} select key, coalesce(b.status, f.status) as status, coalesce(b.cust, f.cust) as cust from base b full join fixes f using (key)")
def overlay_full_join(spark: SparkSession, sf: str) -> DataFrame:
    base, _, fixes = _layers(spark, sf)
    return C.overlay_join(base, fixes, "key")


STAGE = """
with lines as (select l_orderkey as key, count(*)::bigint as n_lines, sum(l_quantity::bigint)::bigint as qty from lineitem group by 1),
cat as (select key, o_totalprice as score, n_lines, qty, case when n_lines > 4 then true when n_lines > 2 then false end as done from (select o_orderkey as key, o_totalprice from orders) full join lines using (key)),
work as (select *, row_number() over (order by key) - 1 as i, count(*) over () as n from cat where score >= 100000 and done is distinct from true)
select floor(((i + 1) * 7 - 1) / n)::int as rank, count(*)::bigint as total, count(n_lines)::bigint as n_n_lines, coalesce(sum(qty), 0)::bigint as qty from work group by 1
"""


@query(STAGE)
def stage_job(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship: overlay, threshold, not-done filter, contiguous shards, statistics."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("score"))
    lines = _layers(spark, sf)[1].drop("status").withColumn("done", F.expr("case when n_lines > 4 then true when n_lines > 2 then false end"))
    cat = C.overlay([orders, lines], "key")
    work = C.worklist(cat, "key", [C.at_least("score", 100000), C.not_done(cat, "done")])
    return C.with_shard(work, 7, "key").groupBy("rank").agg(F.count("*").alias("total"), F.count("n_lines").alias("n_n_lines"), F.coalesce(F.sum("qty"), F.lit(0)).alias("qty"))


@query("select d.doc_id, l.quality, l.toxic from documents d left join labels l using (doc_id) where l.quality is distinct from 1")
def worklist_docs(spark: SparkSession, sf: str) -> DataFrame:
    """A label that is missing isn't done."""
    cat = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left").withColumn("ok", F.col("quality") == 1)
    return cat.where(C.not_done(cat, "ok")).select("doc_id", "quality", "toxic")


@query("select doc_id from documents d left join labels l using (doc_id) where n_chars <= 3000 and (quality is distinct from 1 or toxic is distinct from 0)")
def any_incomplete(spark: SparkSession, sf: str) -> DataFrame:
    """At least one of several stages isn't done, within an upper bound."""
    cat = table(spark, sf, "documents").select("doc_id", "n_chars").join(table(spark, sf, "labels"), "doc_id", "left")
    cat = cat.withColumns({"q": F.col("quality") == 1, "t": F.col("toxic") == 0})
    return cat.where(C.at_most("n_chars", 3000) & C.any_not_done(cat, ["q", "t"])).select("doc_id")


@query("select doc_id from documents d where exists (select 1 from benchmark b where b.item_id = d.doc_id)")
def instances_semi(spark: SparkSession, sf: str) -> DataFrame:
    return C.only(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id")), "doc_id")


@query("select doc_id from documents d where n_chars > 200 and not exists (select 1 from labels l where l.doc_id = d.doc_id)")
def done_anti(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    return C.worklist(docs, "doc_id", [F.col("n_chars") > 200], done=table(spark, sf, "labels")).select("doc_id")


@query("select printf('%s/%s/view_%02d', role, conv_id::varchar, turn::int) as key from conversations c where role <> 'system' and not exists (select 1 from conversations d where d.conv_id = c.conv_id and d.turn = c.turn and d.turn % 3 = 0)")
def composite_anti(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select(C.view_key("role", "conv_id", "turn").alias("key"), "turn", "role")
    return C.without(rows.where("role <> 'system'"), rows.where("turn % 3 = 0"), "key").select("key")


_STEPS = "n_chars >= 100", "lang = 'en'", "quality = 1", "toxic = 0"


@query("""
with d as (select * from documents left join labels using (doc_id))
select unnest([0, 1, 2, 3, 4])::int as step, unnest(['total', 'long', 'english', 'good', 'clean']) as name, unnest([count(*), count(*) filter (n_chars >= 100),
    count(*) filter (n_chars >= 100 and lang = 'en'), count(*) filter (n_chars >= 100 and lang = 'en' and quality = 1),
    count(*) filter (n_chars >= 100 and lang = 'en' and quality = 1 and toxic = 0)])::bigint as survivors from d
""")
def funnel_docs(spark: SparkSession, sf: str) -> DataFrame:
    """All survivor counts in one aggregation."""
    rows = table(spark, sf, "documents").select("doc_id", "n_chars", "lang").join(table(spark, sf, "labels"), "doc_id", "left")
    return C.funnel(rows, list(zip(("long", "english", "good", "clean"), map(F.expr, _STEPS), strict=True)))


@query("select lang, count(*)::bigint as total, count(quality)::bigint as n_quality, coalesce(sum((quality = 1)::int), 0)::bigint as n_good, coalesce(sum((toxic = 1)::int), 0)::bigint as n_bad from documents left join labels using (doc_id) group by lang")
def stage_stats(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left").withColumns({"good": F.col("quality") == 1, "bad": F.col("toxic") == 1})
    return C.stage_stats(rows, ["quality"], ["good", "bad"], ["lang"])


@query("select coalesce(case when event_id % 7 <> 0 then event_type end, 'unknown') as status, count(*)::bigint as n from events group by 1")
def status_hist(spark: SparkSession, sf: str) -> DataFrame:
    return C.status_histogram(table(spark, sf, "events").select(F.expr("case when event_id % 7 <> 0 then event_type end").alias("status")))


@query("""
select case when o_orderkey % 11 = 0 then 'missing_mesh' when o_orderkey % 13 = 0 then 'missing_camera' when n_lines <> mx then 'face_mismatch' when n_lines > 6 then 'skipped_too_many_faces' else 'success' end as status, count(*)::bigint as n
from orders join (select l_orderkey, count(*) as n_lines, max(l_linenumber) as mx from lineitem group by 1) on l_orderkey = o_orderkey group by 1
""")
def classify_status(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n_lines"), F.max("l_linenumber").alias("mx"))
    rows = table(spark, sf, "orders").select("o_orderkey").join(lines, F.col("l_orderkey") == F.col("o_orderkey"))
    k = F.col("o_orderkey")
    return C.status_histogram(rows.select(C.classify_status(k % 11 == 0, k % 13 == 0, F.col("n_lines"), F.col("mx"), 6).alias("status")))


@query("with o as (select o_orderkey, row_number() over (order by o_orderkey) - 1 as i, count(*) over () as n from orders) select o_orderkey, floor(((i + 1) * 7 - 1) / n)::int as rank from o")
def shard_range(spark: SparkSession, sf: str) -> DataFrame:
    """O1: contiguous shards from a two-phase global index."""
    return C.with_shard(table(spark, sf, "orders").select("o_orderkey"), 7, "o_orderkey")


@query("""
with o as (select o_orderkey, o_orderstatus, row_number() over (order by o_orderkey) - 1 as i, count(*) over () as n from orders where o_orderstatus = 'F')
select o_orderkey from o where floor(((i + 1) * 5 - 1) / n) = 3
""")
def filter_before_shard(spark: SparkSession, sf: str) -> DataFrame:
    return C.filter_then_shard(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), 5, 3, F.col("o_orderstatus") == "F", "o_orderkey").select("o_orderkey")


@query("""
with o as (select o_orderkey, o_orderstatus, row_number() over (order by o_orderkey) - 1 as i, count(*) over () as n from orders)
select o_orderkey from o where floor(((i + 1) * 5 - 1) / n) = 3 and o_orderstatus = 'F'
""")
def shard_before_filter(spark: SparkSession, sf: str) -> DataFrame:
    return C.shard_then_filter(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), 5, 3, F.col("o_orderstatus") == "F", "o_orderkey").select("o_orderkey")


@query("select c_custkey, row_number() over (order by case when c_mktsegment = 'BUILDING' then 0 else 1 end, c_custkey) - 1 as i from customer")
def priority_first(spark: SparkSession, sf: str) -> DataFrame:
    return C.priority_first(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), F.col("c_mktsegment") == "BUILDING", "c_custkey").select("c_custkey", "i")


@query("select user_id, last.event_id as event_id, last.event_type as event_type, round(last.value, 6) as value from (select user_id, max_by({'event_id': event_id, 'event_type': event_type, 'value': value}, event_id) as last from events group by user_id)")
def last_writer(spark: SparkSession, sf: str) -> DataFrame:
    """The last record of each key."""
    rows = table(spark, sf, "events").select("user_id", "event_id", "event_type", F.round("value", 6).alias("value"), F.col("event_id").alias("o"))
    return C.last_writer(rows, "user_id", "o").drop("o")


@query("select p.n_name as name, 'nation' as kind, n_nationkey::bigint as id from nation p join (select distinct c_nationkey from customer intersect select distinct s_nationkey from supplier) on c_nationkey = n_nationkey union all select n_name, 'none', n_nationkey::bigint from nation where n_nationkey in (select n_nationkey from nation except select s_nationkey from supplier)")
def set_ops(spark: SparkSession, sf: str) -> DataFrame:
    """Intersection and difference of key sets."""
    nation = table(spark, sf, "nation")
    c, s = table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")), table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k"))
    out = lambda keys, kind: nation.join(keys, F.col("k") == F.col("n_nationkey"), "left_semi").select(F.col("n_name").alias("name"), F.lit(kind).alias("kind"), F.col("n_nationkey").cast("long").alias("id"))
    return out(c.intersect(s), "nation").union(out(nation.select(F.col("n_nationkey").alias("k")).exceptAll(s.distinct()), "none"))


@query("select c.c_custkey, r.r_name from customer c join nation n on c.c_nationkey = n.n_nationkey join region r on lower(r.r_name) = lower(case when n.n_regionkey = 0 then 'AFRICA' when n.n_regionkey = 1 then 'america' when n.n_regionkey = 2 then 'Asia' end)")
def bridge_join(spark: SparkSession, sf: str) -> DataFrame:
    """Two hops, the second on a derived, case-insensitive key."""
    bridge = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.expr("lower(case when n_regionkey = 0 then 'AFRICA' when n_regionkey = 1 then 'america' when n_regionkey = 2 then 'Asia' end)").alias("uid"))
    region = table(spark, sf, "region").select(F.lower("r_name").alias("uid"), "r_name")
    return table(spark, sf, "customer").join(bridge, "c_nationkey").join(region, "uid").select("c_custkey", "r_name")


@query("select p_partkey, p_name from part join (select distinct l_partkey as k, 'part' || (l_partkey % 50)::varchar as h from lineitem) on k = p_partkey where h = 'part' || (p_partkey % 47)::varchar")
def verified_fetch(spark: SparkSession, sf: str) -> DataFrame:
    """Rows whose hash agrees with the catalog's."""
    part = table(spark, sf, "part").select("p_partkey", "p_name", F.concat(F.lit("part"), (F.col("p_partkey") % 47).cast("string")).alias("sha"))
    got = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.concat(F.lit("part"), (F.col("l_partkey") % 50).cast("string")).alias("found")).distinct()
    good, _ = C.verified(part, got, "sha", "p_partkey", "found")
    return good.join(part.select("p_partkey", "p_name"), "p_partkey").select("p_partkey", "p_name")


@query("select page_id, split_part(split_part(url, '://', 2), '/', 1) as host, list_extract(string_split(url, '/'), -1) as base from pages")
def path_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Path functions."""
    return table(spark, sf, "pages").select("page_id", F.split_part(F.split_part("url", F.lit("://"), F.lit(2)), F.lit("/"), F.lit(1)).alias("host"), S.base_name(F.col("url")).alias("base"))


@query("select s_suppkey, view::int as view from supplier, unnest([0, 3, 5]) as t(view)")
def cross_views(spark: SparkSession, sf: str) -> DataFrame:
    return C.cross_views(table(spark, sf, "supplier").select("s_suppkey"), [0, 3, 5])


@query("select max(o_orderkey)::bigint as step from orders")
def latest_step(spark: SparkSession, sf: str) -> DataFrame:
    return C.latest_step(table(spark, sf, "orders").select(F.format_string("ckpt/denoiser_step%07d.pt", "o_orderkey").alias("path")))


# --- sampling -------------------------------------------------------------------------------------------------------


@query("select o_orderkey, row_number() over (order by md5('45:' || o_orderkey::varchar), o_orderkey) - 1 as i from orders")
def seeded_epoch(spark: SparkSession, sf: str) -> DataFrame:
    """The permutation of seed 42, epoch 3."""
    return sampling.epoch_order(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 42, 3)


@query("""
with o as (select c_custkey, row_number() over (order by md5('1:' || c_custkey::varchar), c_custkey) - 1 as i, count(*) over () as n from customer),
e as (select c_custkey, i, n from o union all select c_custkey, i + n, n from o where i < (-n % 7 + 7) % 7)
select c_custkey, i from e where i % 7 = 2 and floor(i / 7) >= 3
""")
def rank_stride(spark: SparkSession, sf: str) -> DataFrame:
    """Padded to a multiple of 7 ranks, rank 2's stride, resumed after 3 rows."""
    rows = sampling.epoch_order(table(spark, sf, "customer").select("c_custkey"), "c_custkey", 1, 0)
    return sampling.rank_slice(sampling.even_total(rows, 7), 7, 2, 3)


@query()
def balanced_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of each block of 64 dealt to 8 groups by length, heaviest first."""
    docs = table(spark, sf, "documents").select("doc_id", "n_chars", F.floor(F.col("doc_id") / 64).alias("batch"))
    return sampling.balanced_groups(docs, "batch", "doc_id", "n_chars", 8, equal=True)


@query()
def balanced_sampler(spark: SparkSession, sf: str) -> DataFrame:
    """Shuffled, padded, balanced over 4 ranks in macro-batches."""
    return sampling.balanced_sampler(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id", "n_chars", 42, 0, 4, 8)


@query("""
with k as (select s_suppkey, (('0x' || md5('0:k:' || s_suppkey::varchar)[:8])::bigint % 4) + 1 as k from supplier),
v as (select s_suppkey, k, view::int as view, row_number() over (partition by s_suppkey order by ('0x' || md5('0:' || view::varchar || ':' || s_suppkey::varchar)[:8])::bigint, view) as r from k, unnest(range(0, 12)) as t(view))
select s_suppkey, view from v where r <= k
""")
def view_choice(spark: SparkSession, sf: str) -> DataFrame:
    """Up to 4 distinct views of 12 for each row."""
    return sampling.pick_views(table(spark, sf, "supplier").select("s_suppkey"), "s_suppkey", 12, 4)


# --- extensions -----------------------------------------------------------------------------------------------------


@query("select time_bucket(interval 1 hour, ts) as start, event_type, count(*)::bigint as n, sum(round(value * 100)::bigint)::bigint as total from events group by 1, 2")
def hourly_events(spark: SparkSession, sf: str) -> DataFrame:
    """Extension: tumbling windows; the same function runs on a stream with a watermark."""
    rows = table(spark, sf, "events").withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    return event_windows(rows, "ts", "event_type", "cents", "1 hour")


@query("""
with g as (select user_id, ts, case when ts <= lag(ts) over w + interval 30 minute then 0 else 1 end as opens from events window w as (partition by user_id order by ts)),
s as (select user_id, ts, sum(opens) over (partition by user_id order by ts rows unbounded preceding) as s from g)
select user_id, min(ts) as start, max(ts) + interval 30 minute as stop, count(*)::bigint as n from s group by user_id, s
""")
def user_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Extension: session windows with a gap of 30 minutes."""
    return sessions(table(spark, sf, "events"), "ts", "user_id", "30 minutes")
