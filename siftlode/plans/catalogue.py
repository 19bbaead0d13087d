"""Queries over the driver's tables, each with its SQL.

Adapters: customers are sources (BUILDING ones hospitals), orders their records, line items evidence and repeated
records, events crawl results and reviews; earlier and later runs are made from the tables by key arithmetic.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftlode.functions import dates, text
from siftlode.operators import aggregates, changes, joins, ordering, rules, search
from siftlode.sources.tables import table

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@query("""
select o_orderkey, c_name as institution, case when c_mktsegment = 'BUILDING' then n_name end as canton,
  coalesce(c_mktsegment, 'unknown') as institution_type
from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey""")
def enrich_left_join(spark, d):
    """Records with their source's name; the canton only for hospitals."""
    sources = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    sources = sources.select(F.col("c_custkey").alias("source_id"), F.col("c_name").alias("institution"), F.col("n_name").alias("canton"), F.col("c_mktsegment").alias("institution_type"))
    records = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("source_id"), F.lit(None).cast("string").alias("institution"), F.lit(None).cast("string").alias("canton"), F.lit("unknown").alias("institution_type"))
    # the type that fills the canton is the lookup's
    out = joins.enrich(records, sources, "source_id", ["institution", "institution_type"], {"canton": F.col("institution_type") == "BUILDING"})
    return out.drop("source_id")


@query("""
with l as (select l_orderkey, l_linenumber, min(l_partkey) as part from lineitem group by 1, 2),
s as (select l_orderkey, min(part) as part from l group by 1 having count(*) = 1)
select o_orderkey, coalesce(l.part, s.part) as part from orders
left join l on o_orderkey = l.l_orderkey and l.l_linenumber = o_custkey % 3 + 1 left join s on o_orderkey = s.l_orderkey""")
def url_lookup_fallback(spark, d):
    """Lookup by two keys, by one where that is unambiguous."""
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").cast("long").alias("line")).agg(F.min("l_partkey").alias("part"))
    wanted = table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 3 + 1).alias("line"))
    return joins.with_fallback(wanted, lines, ["o_orderkey", "line"], "o_orderkey", "part").select("o_orderkey", "part")


@query("select event_id, coalesce(nullif(json_extract_string(props, '$.error'), ''), 'HTTP ' || cast(event_id % 500 + 100 as varchar)) as label from events where event_type = 'error' or event_id % 500 + 100 >= 400")
def failed_filter_label(spark, d):
    """Failed results with a label."""
    status = F.col("event_id") % 500 + 100
    label = F.coalesce(F.nullif(F.get_json_object("props", "$.error"), F.lit("")), F.concat(F.lit("HTTP "), status.cast("string")))
    return table(spark, d, "events").filter((F.col("event_type") == "error") | (status >= 400)).select("event_id", label.alias("label"))


@query("""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity from (select *, row_number() over (partition by l_orderkey, l_linenumber
  order by l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice) as n from lineitem) where n = 1""")
def first_wins_dedupe(spark, d):
    """Of repeated records the first."""
    order = ["l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"]
    return ordering.first_wins(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], order).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query("""
with m as (select doc_id, row_number() over (partition by text order by doc_id) as n from documents),
k as (select max(doc_id) as last from (select doc_id from m where n = 1 order by doc_id limit 100))
select doc_id, case when n > 1 then 'duplicate' when doc_id <= last then 'kept' else 'beyond-limit' end as status from m, k""")
def url_dedupe_limit_status(spark, d):
    """Duplicates and a limit that they do not consume."""
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("key"))
    return ordering.limit_unique(docs, "key", "doc_id", 100).select("doc_id", "status")


@query("select doc_id, case when doc_id <> min(doc_id) over (partition by text) then min(doc_id) over (partition by text) end as first_position from documents")
def duplicate_previous_index(spark, d):
    """Where a repeated text stood first."""
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("key"))
    return ordering.first_index(docs, ["key"], "doc_id").select("doc_id", "first_position")


@query("select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def duplicate_ids_having(spark, d):
    return table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).filter("n > 1")


@query("select p_partkey, p_name from part where p_partkey not in (select l_partkey from lineitem where l_quantity > 45)")
def anti_no_records(spark, d):
    """Sources without records."""
    used = table(spark, d, "lineitem").filter("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return joins.without(table(spark, d, "part").select("p_partkey", "p_name"), used, "p_partkey")


@query("select doc_id, quality from labels where doc_id not in (select doc_id from documents where lang <> 'en')")
def orphan_refs(spark, d):
    """References that the table does not hold."""
    known = table(spark, d, "documents").filter("lang <> 'en'").select("doc_id")
    return joins.without(table(spark, d, "labels").select("doc_id", "quality"), known, "doc_id")


@query("select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_orderstatus = 'P')")
def semi_failed(spark, d):
    failed = table(spark, d, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.having(table(spark, d, "customer").select("c_custkey", "c_name"), failed, "c_custkey")


@query("""
select 'status' as facet, o_orderstatus as key, count(*) as n from orders group by 2 union all
select 'priority', o_orderpriority, count(*) from orders group by 2 union all
select 'year', cast(year(o_orderdate) as varchar), count(*) from orders group by 2 union all
select 'large', coalesce(case when o_totalprice > 200000 then 'yes' end, 'unknown'), count(*) from orders group by 2""")
def facet_counts(spark, d):
    """Counts of several facets in one pass."""
    rows = table(spark, d, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").alias("year"), F.expr("case when o_totalprice > 200000 then 'yes' end").alias("large"))
    return aggregates.facet_counts(rows, rows.columns)


@query("""
select o_custkey, count(*) filter (o_orderstatus = 'F') as high, count(*) filter (o_orderstatus = 'P') as medium,
  count(*) filter (o_orderstatus = 'O') as low, round(count(*) filter (o_orderstatus = 'F') / nullif(count(*) filter (o_orderstatus <> 'P'), 0), 9) as share
from orders group by 1""")
def conditional_counts_ratio(spark, d):
    when = lambda s: F.count_if(F.col("o_orderstatus") == s)
    share = F.round(F.try_divide(when("F"), F.count_if(F.col("o_orderstatus") != "P")), 9)
    return table(spark, d, "orders").groupBy("o_custkey").agg(when("F").alias("high"), when("P").alias("medium"), when("O").alias("low"), share.alias("share"))


@query("""
with g as (select cast(ts as date) as day, count(*) as n, count(*) filter (event_type = 'error') as failed from events group by 1)
select day, round(failed / n, 9) as failure_rate,
  round(case when lag(n) over (order by day) > 0 then greatest(0, (lag(n) over (order by day) - n) / lag(n) over (order by day)) end, 9) as drop_rate from g""")
def failure_and_drop_rates(spark, d):
    """Per day, against the day before; the window runs over one row a day."""
    days = table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("failed"))
    before = F.lag("n").over(Window.orderBy("day"))
    return days.select("day", F.round(aggregates.rate(F.col("failed"), F.col("n")), 9).alias("failure_rate"), F.round(aggregates.drop_rate(before, F.col("n")), 9).alias("drop_rate"))


@query("""
select c_mktsegment, c_nationkey, min_by(c_name, c_custkey) as first_name, string_agg(distinct o_orderstatus, ',' order by o_orderstatus) as statuses, count(o_orderkey) as n
from customer left join orders on c_custkey = o_custkey and o_totalprice > 300000 group by 1, 2""")
def institution_rollup(spark, d):
    orders = table(spark, d, "orders").filter("o_totalprice > 300000").select("o_custkey", "o_orderkey", "o_orderstatus")
    both = table(spark, d, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    statuses = F.nullif(F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ","), F.lit(""))
    return both.groupBy("c_mktsegment", "c_nationkey").agg(F.min_by("c_name", "c_custkey").alias("first_name"), statuses.alias("statuses"), F.count("o_orderkey").alias("n"))


def _evidence(spark, d):
    lines = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    ahead = dates.months_ahead(F.col("o_orderdate"), F.col("l_shipdate"))
    kind = F.when(F.col("l_returnflag") == "R", "explicit").when(F.col("l_returnflag") == "N", "hospital").otherwise("observed")
    return lines.select("o_custkey", kind.alias("kind"), ahead.alias("months")).filter("months is not null")


_EVIDENCE = """(select o_custkey, case l_returnflag when 'R' then 'explicit' when 'N' then 'hospital' else 'observed' end as kind,
  (year(l_shipdate) - year(o_orderdate)) * 12 + month(l_shipdate) - month(o_orderdate) as months
  from lineitem join orders on l_orderkey = o_orderkey where (year(l_shipdate) - year(o_orderdate)) * 12 + month(l_shipdate) - month(o_orderdate) >= 0)"""


@query(f"select kind, months, count(*) as n from {_EVIDENCE} group by 1, 2")
def lead_time_evidence(spark, d):
    return _evidence(spark, d).groupBy("kind", F.col("months").cast("long").alias("months")).agg(F.count("*").alias("n"))


@query(f"""
select o_custkey, count(*) as evidence, count(*) filter (kind = 'observed') as observed,
  case when count(*) filter (kind = 'hospital') > 0 then 'hospital' when count(*) filter (kind = 'explicit') > 0 then 'explicit'
    when count(*) filter (kind = 'observed') >= 3 then 'observed' else 'estimated' end as basis,
  cast(floor(median(months) + 0.5) as bigint) as median_months, cast(min(months) as bigint) as least, cast(max(months) as bigint) as most
from {_EVIDENCE} group by 1""")
def lead_time_summary(spark, d):
    """Evidence by source with the precedence of its kinds."""
    number = lambda k: F.count_if(F.col("kind") == k)
    counted = _evidence(spark, d).groupBy("o_custkey", "months").agg(F.count("*").alias("n"), *(number(k).alias(k) for k in ("hospital", "explicit", "observed")))
    basis = F.when(F.sum("hospital") > 0, "hospital").when(F.sum("explicit") > 0, "explicit").when(F.sum("observed") >= 3, "observed").otherwise("estimated")
    out = counted.groupBy("o_custkey").agg(
        F.sum("n").alias("evidence"), F.sum("observed").alias("observed"), basis.alias("basis"), F.collect_list(F.struct(F.col("months").alias("value"), "n")).alias("pairs"),
        F.min("months").cast("long").alias("least"), F.max("months").cast("long").alias("most"),
    )
    return out.select("o_custkey", "evidence", "observed", "basis", aggregates.rounded(aggregates.counted_median(F.col("pairs"))).cast("long").alias("median_months"), "least", "most")


@query("""
with r as (select user_id, count(*) as n, count(*) filter (event_type in ('purchase', 'signup')) as positive, count(*) filter (event_type = 'error') as negative, max(ts) as latest from events group by 1)
select c_custkey, coalesce(n, 0) as reports, coalesce(positive, 0) as positive, coalesce(negative, 0) as negative, latest,
  case when coalesce(n, 0) = 0 then 'unverified' when positive > 0 and negative > 0 then 'conflicting' when negative > 0 then 'disputed' else 'verified' end as label
from customer left join r on c_custkey = user_id""")
def community_reliability(spark, d):
    """Reviews aggregated before they are joined, so that nothing fans out."""
    kind = F.col("event_type")
    reviews = table(spark, d, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.count("*").alias("n"), F.count_if(kind.isin("purchase", "signup")).alias("p"), F.count_if(kind == "error").alias("m"), F.max("ts").alias("latest"))
    both = table(spark, d, "customer").select("c_custkey").join(reviews, "c_custkey", "left")
    n, p, m = (F.coalesce(c, F.lit(0)) for c in ("n", "p", "m"))
    label = F.when(n == 0, "unverified").when((p > 0) & (m > 0), "conflicting").when(m > 0, "disputed").otherwise("verified")
    return both.select("c_custkey", n.alias("reports"), p.alias("positive"), m.alias("negative"), "latest", label.alias("label"))


@query("""
with k as (select lang from documents union select case quality when 1 then 'en' else 'it' end from labels)
select k.lang, coalesce(d.n, 0) as documents, coalesce(l.n, 0) as labels from k
left join (select lang, count(*) as n from documents group by 1) d on d.lang = k.lang
left join (select case quality when 1 then 'en' else 'it' end as lang, count(*) as n from labels group by 1) l on l.lang = k.lang""")
def language_summary_union(spark, d):
    """Keys of two tables with counts of both."""
    docs = table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("d"))
    labels = table(spark, d, "labels").groupBy(F.when(F.col("quality") == 1, "en").otherwise("it").alias("lang")).agg(F.count("*").alias("l"))
    return docs.join(labels, "lang", "full_outer").select("lang", F.coalesce("d", F.lit(0)).alias("documents"), F.coalesce("l", F.lit(0)).alias("labels"))


_RULES = {
    "low-confidence": "o_orderstatus = 'O'",
    "large-amount": "o_totalprice > 250000",
    "urgent-and-old": "o_orderpriority = '1-URGENT' and o_orderdate < timestamp '1997-01-01'",
    "no-source": "o_custkey % 50 = 0",
}


@query(" union all ".join(f"select o_orderkey, '{n}' as rule from orders where {c}" for n, c in _RULES.items()))
def issue_explosion(spark, d):
    """A row for each rule that a record breaks."""
    return rules.issues(table(spark, d, "orders"), "o_orderkey", {n: F.expr(c.replace("timestamp '", "timestamp_ntz '")) for n, c in _RULES.items()})


@query("select o_orderkey, concat_ws(';', " + ", ".join(f"case when {c} then '{n}' end" for n, c in _RULES.items()) + ") as reasons, " + " + ".join(f"cast({c} as bigint)" for c in _RULES.values()) + " as priority from orders")
def review_reasons(spark, d):
    out = rules.reasons(table(spark, d, "orders"), {n: F.expr(c.replace("timestamp '", "timestamp_ntz '")) for n, c in _RULES.items()})
    return out.select("o_orderkey", "reasons", "priority")


@query("""
select count(*) as records, count(distinct o_custkey) as sources, count(*) filter (o_orderstatus = 'O') as low,
  round(count(*) filter (o_orderstatus = 'O') / count(*), 9) as low_rate, count(*) filter (o_orderdate < timestamp '1996-01-01') as past,
  (select count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)) as duplicate_ids from orders""")
def quality_gate_metrics(spark, d):
    """One row of metrics."""
    low = F.count_if(F.col("o_orderstatus") == "O")
    main = table(spark, d, "orders").agg(F.count("*").alias("records"), F.count_distinct("o_custkey").alias("sources"), low.alias("low"), F.round(aggregates.rate(low, F.count("*")), 9).alias("low_rate"), F.count_if(F.expr("o_orderdate < timestamp_ntz '1996-01-01'")).alias("past"))
    return main.join(duplicate_ids_having(spark, d).agg(F.count("*").alias("duplicate_ids")), F.lit(True))


_BEFORE = "(select o_orderkey, o_totalprice, o_orderpriority, o_orderdate from orders where o_orderkey % 10 <> 0)"
_AFTER = """(select o_orderkey, case when o_orderkey % 10 = 2 then o_totalprice + 1 else o_totalprice end as o_totalprice,
  case when o_orderkey % 10 in (2, 4) then 'changed' else o_orderpriority end as o_orderpriority, o_orderdate + case when o_orderkey % 10 = 3 then interval 1 day else interval 0 day end as o_orderdate
  from orders where o_orderkey % 10 <> 1)"""


@query(f"""
select * from (select coalesce(a.o_orderkey, b.o_orderkey) as o_orderkey, case when b.o_orderkey is null then 'record-added' when a.o_orderkey is null then 'record-removed'
  when a.o_totalprice <> b.o_totalprice then 'availability-changed' when a.o_orderpriority <> b.o_orderpriority then 'parser-output-changed' end as change_type,
  case when b.o_orderkey is null then 'info' else 'review' end as severity
from {_BEFORE} b full join {_AFTER} a on a.o_orderkey = b.o_orderkey) where change_type is not null""")
def record_diff(spark, d):
    """Records of two runs: a watched column, any other, or a volatile one that does not count."""
    run = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderdate")
    digit = F.col("o_orderkey") % 10
    after = run.filter(digit != 1).withColumn("o_totalprice", F.when(digit == 2, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    after = after.withColumn("o_orderpriority", F.when(digit.isin(2, 4), "changed").otherwise(F.col("o_orderpriority")))
    after = after.withColumn("o_orderdate", F.col("o_orderdate") + F.make_dt_interval(F.when(digit == 3, 1).otherwise(0)))
    return changes.record_changes(run.filter(digit != 0), after, "o_orderkey", ["o_totalprice"], ["o_orderdate"])


_PAGES = """with c as (select doc_id, source, doc_id % 11 = 0 as failed, case when doc_id % 10 = 2 then text || 'x' else text end as text from documents),
p as (select doc_id, source, text from documents where doc_id % 10 <> 0),
m as (select c.doc_id, c.source, p.doc_id is null as added, failed, c.text <> p.text as differs from c left join p on p.doc_id = c.doc_id)
select doc_id, source, 'new-source' as change_type, 'info' as severity from m where added union all
select doc_id, source, 'error', 'review' from m where failed union all
select doc_id, source, 'content-changed', 'review' from m where not added and not failed and differs"""


@query(_PAGES)
def page_diff(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", "text")
    now = docs.withColumn("text", F.when(F.col("doc_id") % 10 == 2, F.concat("text", F.lit("x"))).otherwise(F.col("text")))
    now = now.select("doc_id", "source", F.sha2("text", 256).alias("hash"), (F.col("doc_id") % 11 == 0).alias("failed"))
    before = docs.filter("doc_id % 10 <> 0").select("doc_id", "source", F.sha2("text", 256).alias("hash"))
    return changes.page_changes(before, now, ["doc_id", "source"], "hash", "failed")


@query("select p_partkey, p_name from part where p_size = 10 and contains(lower(concat_ws(' ', p_name, nullif(p_brand, ''), p_type)), 'brand')")
def faceted_search(spark, d):
    out = search.faceted(table(spark, d, "part").withColumn("size", F.col("p_size").cast("string")), {"size": "10", "p_brand": ""}, " BRAND ", ["p_name", "p_brand", "p_type"])
    return out.select("p_partkey", "p_name")


@query("select p_brand as value, max_by(p_name, p_partkey) as label from part group by 1")
def facet_options(spark, d):
    """Distinct values, the last label of each."""
    return table(spark, d, "part").groupBy(F.col("p_brand").alias("value")).agg(F.max_by("p_name", "p_partkey").alias("label"))


@query("""
with n as (select distinct p_name as name, string_split(p_name, ' ') as t from part),
p as (select a.name as left_name, b.name as right_name, len(list_filter(a.t, lambda x: list_contains(b.t, x))) / least(len(a.t), len(b.t)) as score, least(len(a.t), len(b.t)) as small from n a, n b)
select left_name, right_name, round(score, 9) as score from p where score >= 0.75 and small >= 2""")
def token_overlap_match(spark, d):
    """Names that share most tokens; pairs meet on a token instead of a cross join."""
    names = table(spark, d, "part").select(F.col("p_name").alias("name")).distinct()
    return search.token_matches(names, names).withColumn("score", F.round("score", 9))


@query("select page_id, replace(replace(replace(trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '[\\s\\x{a0}]+', ' ', 'g')), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') as title from pages")
def html_title(spark, d):
    return table(spark, d, "pages").select("page_id", text.html_title(F.col("html")).alias("title"))


_VISIBLE = "regexp_replace(regexp_replace(html, '(?is)<!--.*?-->', ' ', 'g'), '(?is)<head[^>]*>.*?</head>', ' ', 'g')"
for _tag in text.HIDDEN_TAGS:
    _VISIBLE = f"regexp_replace({_VISIBLE}, '(?is)<{_tag}\\b[^>]*>.*?</{_tag}>', ' ', 'g')"


@query(f"select page_id, length(t) as n_chars, sha256(t) as hash from (select page_id, trim(regexp_replace(regexp_replace({_VISIBLE}, '(?s)<[^>]*>', ' ', 'g'), '[\\s\\x{{a0}}]+', ' ', 'g')) as t from pages)")
def html_visible_text_stats(spark, d):
    words = text.visible_text(F.col("html"))
    return table(spark, d, "pages").select("page_id", F.char_length(words).cast("long").alias("n_chars"), F.sha2(words, 256).alias("hash"))


@query("select page_id, count(distinct h) as n_links, string_agg(distinct h, ' ' order by h) as links from (select page_id, unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*href=\"([^\"#]+)', 1)) as h from pages) group by 1")
def html_links(spark, d):
    found = text.links(F.col("html"))
    return table(spark, d, "pages").select("page_id", F.size(found).cast("long").alias("n_links"), F.array_join(F.array_sort(found), " ").alias("links")).filter("n_links > 0")


@query(f"select doc_id, e as email from (select distinct doc_id, lower(unnest(regexp_extract_all(text, '{text.EMAIL}'))) as e from documents)")
def emails(spark, d):
    return table(spark, d, "documents").select("doc_id", F.explode(text.emails(F.col("text"))).alias("email"))


@query("select doc_id, sha256(trim(regexp_replace(text, '[\\s\\x{a0}]+', ' ', 'g'))) as hash from documents")
def text_hash(spark, d):
    return table(spark, d, "documents").select("doc_id", text.text_hash(F.col("text")).alias("hash"))


@query("select p_partkey, regexp_replace(regexp_replace(lower(strip_accents(p_name || ' é ' || p_type)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') as slug from part")
def slug_and_id(spark, d):
    return table(spark, d, "part").select("p_partkey", text.slug(F.concat("p_name", F.lit(" é "), "p_type")).alias("slug"))


@query("""
select doc_id, count(*) as n, cast(max(length(s)) as bigint) as longest from (select doc_id, trim(regexp_replace(s, '[\\s\\x{a0}]+', ' ', 'g')) as s from
  (select doc_id, unnest(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(10), 'g'), chr(10))) as s from documents)) where s <> '' group by 1""")
def sentence_split(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.explode(text.sentences(F.col("text"))).alias("s"))
    return rows.groupBy("doc_id").agg(F.count("*").alias("n"), F.max(F.char_length("s")).cast("long").alias("longest"))


@query("select event_id, json_extract_string(props, '$.page') as page, user_id % 10 as bucket from events")
def json_props_extract(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.page").alias("page"), (F.col("user_id") % 10).alias("bucket"))


@query("select count(*) as total, count(distinct user_id) as sources, count(*) filter (event_type = 'error') as needing_review, max(ts) as last_checked from events")
def global_summary(spark, d):
    return table(spark, d, "events").agg(F.count("*").alias("total"), F.count_distinct("user_id").alias("sources"), F.count_if(F.col("event_type") == "error").alias("needing_review"), F.max("ts").alias("last_checked"))


@query("select conv_id, turn, lead(turn) over (partition by conv_id order by turn) as next_turn from conversations where role = 'user'")
def heading_slices(spark, d):
    """Where the slice that starts at a heading ends."""
    following = F.lead("turn").over(Window.partitionBy("conv_id").orderBy("turn"))
    return table(spark, d, "conversations").filter("role = 'user'").select("conv_id", "turn", following.alias("next_turn"))
