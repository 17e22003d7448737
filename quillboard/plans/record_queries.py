"""Queries of records: acceptance, states, histograms, digests and the dates of statements."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillboard.functions import text as tx
from quillboard.operators import records as rc
from quillboard.operators.rater import r6
from quillboard.plans.oracles import F as FC, TOK
from quillboard.plans.registry import query
from quillboard.sources.tables import forecasts, read

A = """rec as (select o_orderkey id, o_custkey person, o_orderpriority[1] contract, case when o_orderkey % 5 = 0 then 'lab' else 'field' end harness, o_orderstatus status, o_orderdate::date said, o_totalprice price,
 o_orderkey % 2 = 0 or o_custkey % 3 = 0 ex, case when o_orderstatus <> 'P' then o_custkey % 4 <> 0 and o_orderkey % 7 <> 0 end vf, o_orderkey % 11 = 0 held from orders), ac as (select *, ex and coalesce(vf, false) and not held acc from rec)"""


def _records(spark, d):
    o = read(spark, d, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    gates = lambda x: F.create_map(*[y for g in rc.GATES for y in (F.lit(g), x if g == "dated" else F.lit(True))])
    ex = rc.extraction_qualifies(gates((k % 2 == 0) | (c % 3 == 0)), F.lit("holds"))
    vf = rc.verification_qualifies(F.when(F.col("o_orderstatus") != "P", "ok").otherwise("not_run"), gates(c % 4 != 0), F.when(k % 7 == 0, "other").otherwise("subject"), F.lit(True))
    holds = F.array_compact(F.array(F.when(k % 11 == 0, "placeholder_date")))
    rows = o.select(k.alias("id"), c.alias("person"), F.substring("o_orderpriority", 1, 1).alias("contract"), F.when(k % 5 == 0, "lab").otherwise("field").alias("harness"), F.col("o_orderstatus").alias("status"), F.to_date("o_orderdate").alias("said"), F.col("o_totalprice").alias("price"), ex.alias("ex"), vf.alias("vf"), holds.alias("holds"))
    return rows.withColumn("acc", rc.accepted(F.col("ex"), F.col("vf"), F.col("holds")))


@query(f"with {A} select id, ex, vf, held, acc from ac")
def acceptance(spark, d):
    """Whether extraction and verification qualify, whether the date is held, and whether a record is accepted."""
    return _records(spark, d).select("id", "ex", "vf", (F.size("holds") > 0).alias("held"), "acc")


@query(f"with {A} select contract, status, count(*) records, count(*) filter (vf is not null) reviewed, count(*) filter (acc) accepted, count(*) filter (vf is not null and not acc) rejected, round(count(*) filter (acc) / nullif(count(*) filter (vf is not null), 0), 6) rate from ac group by contract, status")
def acceptance_by_contract(spark, d):
    g = _records(spark, d).groupBy("contract", "status")
    reviewed, acc = F.count_if(F.col("vf").isNotNull()), F.count_if("acc")
    return g.agg(F.count("*").alias("records"), reviewed.alias("reviewed"), acc.alias("accepted"), F.count_if(F.col("vf").isNotNull() & ~F.col("acc")).alias("rejected"), r6(acc / F.nullif(reviewed, F.lit(0))).alias("rate"))


@query(f"with {A} select harness, case when harness = 'lab' then 'field' else 'lab' end verifier, count(*) filter (vf is not null) reviewed, count(*) filter (acc) accepted, round(count(*) filter (acc) / nullif(count(*) filter (vf is not null), 0), 6) rate from ac group by harness")
def acceptance_by_harness(spark, d):
    """By the harness of extraction and that of verification; a record without one stops the job."""
    named = F.coalesce("harness", F.raise_error(F.lit("a record without a harness")).cast("string"))
    g = _records(spark, d).groupBy(named.alias("harness"), F.when(F.col("harness") == "lab", "field").otherwise("lab").alias("verifier"))
    reviewed, acc = F.count_if(F.col("vf").isNotNull()), F.count_if("acc")
    return g.agg(reviewed.alias("reviewed"), acc.alias("accepted"), r6(acc / F.nullif(reviewed, F.lit(0))).alias("rate"))


@query(
    f"""with {A} select coalesce(contract, 'corpus') contract, count(*) n, count(distinct person) people, count(*) filter (ex) extracted, count(*) filter (vf) verified, count(*) filter (vf is null) unverified, count(*) filter (held) held, count(*) filter (acc) accepted,
 count(*) filter (status = 'F') done, count(*) filter (status = 'O') open_, count(*) filter (status = 'P') pending, count(*) filter (harness = 'lab') lab, count(*) filter (price < 50000) small, count(*) filter (price >= 50000 and price < 150000) medium, count(*) filter (price >= 150000) large,
 min(said) first_said, max(said) last_said, count(distinct year(said)) years_, round(avg(price), 4) mean_price, round(median(price), 4) median_price from ac group by rollup (contract)"""
)
def corpus_summary(spark, d):
    """Conditional counts and histograms of each contract's records and of the whole corpus."""
    g = _records(spark, d).rollup("contract")
    n = F.count_if
    out = g.agg(
        F.count("*").alias("n"), F.count_distinct("person").alias("people"), n("ex").alias("extracted"), n("vf").alias("verified"), n(F.col("vf").isNull()).alias("unverified"), n(F.size("holds") > 0).alias("held"), n("acc").alias("accepted"),
        n(F.col("status") == "F").alias("done"), n(F.col("status") == "O").alias("open_"), n(F.col("status") == "P").alias("pending"), n(F.col("harness") == "lab").alias("lab"), n(F.col("price") < 50000).alias("small"),
        n((F.col("price") >= 50000) & (F.col("price") < 150000)).alias("medium"), n(F.col("price") >= 150000).alias("large"), F.min("said").alias("first_said"), F.max("said").alias("last_said"), F.count_distinct(F.year("said")).alias("years_"), F.round(F.avg("price"), 4).alias("mean_price"), F.round(F.median("price"), 4).alias("median_price"),
    )
    return out.withColumn("contract", F.coalesce("contract", F.lit("corpus")))


@query(
    f"""with {A}, m as (select person, count(*) records, count(*) filter (acc) accepted from ac group by person), t as (select c_custkey person, c_mktsegment segment from customer), x as (select l_suppkey person, count(*) metas from lineitem group by 1)
 select coalesce(t.person, m.person, x.person) person, segment, coalesce(records, 0) records, coalesce(accepted, 0) accepted, coalesce(metas, 0) metas, case when t.person is null then 'off_roster' when m.person is null then 'no_records' when x.person is null then 'no_metas' else 'full' end state from t full join m on m.person = t.person full join x on x.person = coalesce(t.person, m.person)"""
)
def index_build(spark, d):
    """The full outer join of roster, records and metas, a row for each person that any of them knows."""
    m = _records(spark, d).groupBy("person").agg(F.count("*").alias("records"), F.count_if("acc").alias("accepted")).withColumn("in_m", F.lit(True))
    t = read(spark, d, "customer").select(F.col("c_custkey").alias("person"), F.col("c_mktsegment").alias("segment")).withColumn("in_t", F.lit(True))
    x = read(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("person")).agg(F.count("*").alias("metas")).withColumn("in_x", F.lit(True))
    state = F.when(F.col("in_t").isNull(), "off_roster").when(F.col("in_m").isNull(), "no_records").when(F.col("in_x").isNull(), "no_metas").otherwise("full")
    return t.join(m, "person", "full").join(x, "person", "full").fillna(0, ["records", "accepted", "metas"]).select("person", "segment", "records", "accepted", "metas", state.alias("state"))


@query("select l_returnflag harness, l_linestatus status, count(*) files, sum(len(string_split(l_shipdate::date::varchar, '-')) + l_linenumber)::bigint dropped, max(l_linenumber) most from lineitem group by all")
def meta_summary(spark, d):
    """Files by harness and status, with the sizes of their lists summed."""
    m = read(spark, d, "lineitem").select(F.col("l_returnflag").alias("harness"), F.col("l_linestatus").alias("status"), "l_linenumber", F.concat(F.split(F.to_date("l_shipdate").cast("string"), "-"), F.array_repeat(F.lit("x"), F.col("l_linenumber"))).alias("dropped"))
    return m.groupBy("harness", "status").agg(F.count("*").alias("files"), F.sum(F.size("dropped")).alias("dropped"), F.max("l_linenumber").alias("most"))


@query(f"with {FC}, c as (select person, said, sha256(string_agg(id::varchar || ' ' || kind, chr(10) order by id::varchar || ' ' || kind)) digest, count(*) n from f group by all) select * from c")
def cell_digests(spark, d):
    """A digest of the records of each person and day, whatever order they come in; cells are small."""
    return forecasts(spark, d).groupBy("person", "said").agg(rc.digest_of(F.concat_ws(" ", F.col("id").cast("string"), "kind")).alias("digest"), F.count("*").alias("n"))


@query(
    """with o as (select o_orderpriority p, case when o_orderkey % 17 <> 0 then year(o_orderdate) end y from orders), l as (select min(y) filter (c >= 200) lo, max(y) hi from (select y, count(*) c from o where y is not null group by y)), ax as (select unnest(range(lo, hi + 1)) as year from l),
 c as (select p, case when y < lo then -1 else y end as year, count(*) n from o, l group by all) select g.p, ax.year::int as year, coalesce(n, 0) n from (select distinct p from o) g cross join ax left join c on c.p = g.p and c.year = ax.year union all select p, year::int, n from c where year is null or year = -1"""
)
def statement_years(spark, d):
    """Counts by year without gaps; the years before the first full one together, and those without a date."""
    o = read(spark, d, "orders").select(F.col("o_orderpriority").alias("p"), F.when(F.col("o_orderkey") % 17 != 0, F.to_date("o_orderdate")).alias("day"))
    return rc.year_axis(o, "p", "day", 200)


S = f"""{FC}, st as (select f.*, f.id % 19 = 0 withdrawn, f.id % 23 = 0 restated, case when f.id % 29 <> 0 then f.deadline end dl, f.kind <> 'signup' testable, o.o_orderstatus res from f left join orders o on o.o_orderkey = f.id),
 ss as (select *, case when withdrawn then 'withdrawn' when restated then 'restated' when dl is null then 'no_deadline' when dl > date '2024-02-15' then 'not_due' when not testable then 'not_testable' when res is null then 'awaiting' when res <> 'P' then 'scored' else 'unresolvable' end state from st)"""


def _states(spark, d):
    f = forecasts(spark, d).join(read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("res")), "id", "left")
    deadline = F.when(F.col("id") % 29 != 0, F.col("deadline"))
    scored = F.coalesce(F.col("res") != "P", F.lit(False))
    return f.withColumn("state", rc.state(F.col("id") % 19 == 0, F.col("id") % 23 == 0, deadline, F.lit("2024-02-15").cast("date"), F.col("kind") != "signup", F.col("res"), scored))


@query(f"with {S} select id, state from ss")
def record_states(spark, d):
    return _states(spark, d).select("id", "state")


STATES = ("withdrawn", "restated", "no_deadline", "not_due", "not_testable", "awaiting", "unresolvable", "scored")


@query(f"with {S} select person, count(*) total, " + ", ".join(f"count(*) filter (state = '{s}') {s}" for s in STATES) + " from ss group by person")
def prediction_buckets(spark, d):
    """Records of each person by state; states that do not add up to the total stop the job."""
    per = _states(spark, d).groupBy("person").agg(F.count("*").alias("t"), *[F.count_if(F.col("state") == s).alias(s) for s in STATES])
    return per.select("person", rc.reconciled(F.col("t"), sum((F.col(s) for s in STATES), F.lit(0))).alias("total"), *STATES)


@query(f"with {S}, p as (select person, count(*) n, count(*) filter (state = 'scored') scored from ss group by person) select count(*) people, count(*) filter (n >= 4) listed, sum(n) filter (n >= 4)::bigint listed_records, sum(n)::bigint records, sum(scored) filter (n >= 4)::bigint listed_scored, sum(scored)::bigint scored from p")
def listed_corpus(spark, d):
    """Totals over persons that are listed and over all; both must add up."""
    per = _states(spark, d).groupBy("person").agg(F.count("*").alias("n"), F.count_if(F.col("state") == "scored").alias("scored"))
    on, off = F.col("n") >= 4, F.col("n") < 4
    some = lambda c, x: F.coalesce(F.sum(F.when(c, F.col(x))), F.lit(0))
    one = per.agg(F.count("*").alias("people"), F.count_if(on).alias("listed"), some(on, "n").alias("listed_records"), some(off, "n").alias("rest"), F.sum("n").alias("t"), some(on, "scored").alias("listed_scored"), F.sum("scored").alias("scored"))
    return one.select("people", "listed", "listed_records", rc.reconciled(F.col("t"), F.col("listed_records") + F.col("rest")).alias("records"), "listed_scored", "scored")


@query(
    rf"""with {TOK}, w as (select d.doc_id, source, lang, len(w) n from documents d join t on t.doc_id = d.doc_id), a as (select w.*, coalesce(quality, 0) acc from w left join labels l on l.doc_id = w.doc_id)
 select source, count(*) docs, sum(n)::bigint words, sum(acc)::bigint accepted, round(10000.0 * sum(acc) / nullif(sum(n), 0), 6) per_10k, round(10000.0 * sum(acc) filter (lang = 'en') / nullif(sum(n) filter (lang = 'en'), 0), 6) per_10k_en, sum(acc) filter (lang = 'en') < 2 and sum(acc) >= 2 crossed from a group by source"""
)
def supplement_yield(spark, d):
    """Accepted documents in ten thousand words by source, before and with the supplement of other languages, and who crossed the floor by it."""
    docs = read(spark, d, "documents").select("doc_id", "source", "lang", F.size(tx.tokens(F.col("text"))).cast("long").alias("n"))
    a = docs.join(read(spark, d, "labels").select("doc_id", F.col("quality").cast("long").alias("acc")), "doc_id", "left").fillna(0, ["acc"])
    en = lambda c: F.sum(F.when(F.col("lang") == "en", F.col(c)))
    rate = lambda x, y: r6(10000.0 * x / F.nullif(y, F.lit(0)))
    return a.groupBy("source").agg(F.count("*").alias("docs"), F.sum("n").alias("words"), F.sum("acc").alias("accepted"), rate(F.sum("acc"), F.sum("n")).alias("per_10k"), rate(en("acc"), en("n")).alias("per_10k_en"), ((en("acc") < 2) & (F.sum("acc") >= 2)).alias("crossed"))


@query(
    rf"""with {TOK}, e as (select source, unnest(w) word from documents d join t on t.doc_id = d.doc_id where length(source) > 0), c as (select word, source, count(*) n from e group by all), s as (select word, sum(n)::bigint n, count(*) sources, max(n) top from c group by word)
 select word, n, sources, round((n - top) / n, 6) elsewhere, (n - top) / n >= 0.7 and sources >= 3 ordinary from s where n >= 20"""
)
def word_spread(spark, d):
    """How much of a word's use is outside the source that uses it most: an ordinary word is spread."""
    words = read(spark, d, "documents").select("source", F.explode(tx.tokens(F.col("text"))).alias("word")).groupBy("word", "source").agg(F.count("*").alias("n"))
    s = words.groupBy("word").agg(F.sum("n").alias("n"), F.count("*").alias("sources"), F.max("n").alias("top")).where("n >= 20")
    share = (F.col("n") - F.col("top")) / F.col("n")
    return s.select("word", "n", "sources", r6(share).alias("elsewhere"), ((share >= 0.7) & (F.col("sources") >= 3)).alias("ordinary"))


@query(rf"with {TOK} select lang, count(*) docs, sum(len(w))::bigint words, sum(case when l.doc_id is not null then len(w) else 0 end)::bigint on_board, sum(case when l.doc_id is null then len(w) else 0 end)::bigint off_board from documents d join t on t.doc_id = d.doc_id left join labels l on l.doc_id = d.doc_id group by lang")
def corpus_words(spark, d):
    """Words on and off the board by language."""
    docs = read(spark, d, "documents").select("doc_id", "lang", F.size(tx.tokens(F.col("text"))).cast("long").alias("n")).join(read(spark, d, "labels").select("doc_id", F.lit(True).alias("on")), "doc_id", "left")
    return docs.groupBy("lang").agg(F.count("*").alias("docs"), F.sum("n").alias("words"), F.sum(F.when(F.col("on"), F.col("n")).otherwise(0)).alias("on_board"), F.sum(F.when(F.col("on").isNull(), F.col("n")).otherwise(0)).alias("off_board"))


@query(f"with {FC} select id, round(p * log2(q / p) + (1 - p) * log2((1 - q) / (1 - p)), 6) expected, p < 0.0101 or p > 0.9899 clamped from (select id, p, least(0.99, greatest(0.01, p + 0.1)) q from f)")
def expected_scores(spark, d):
    f = forecasts(spark, d)
    return f.select("id", r6(rc.expected_points(F.col("p"), F.col("p") + 0.1)).alias("expected"), ((F.col("p") < 0.0101) | (F.col("p") > 0.9899)).alias("clamped"))


@query(
    """with o as (select o_orderkey id, o_orderdate::date said, (o_orderdate::date - (o_custkey % 400)::int) earliest, case when o_orderkey % 3 = 0 then strftime(o_orderdate, '%Y%m%d') end up, o_custkey % 12 + 1 m, o_custkey % 31 + 1 dd from orders),
 y as (select *, list_filter([try_cast(printf('%04d-%02d-%02d', year(said) - b, m, dd) as date) for b in range(0, 9)], lambda x: x is not null and x <= said)[1] yearless from o)
 select id, case when said - earliest = 0 then 'day' when said - earliest <= 31 then 'days' when said - earliest <= 366 then 'months' else 'years' end as precision_, case when up is not null then said end uploaded, coalesce(case when up is not null then said end, earliest) as bound, round((said - date '0001-01-01' + 1) / 365.25, 6) ordinal_years, yearless,
 case when id % 5 = 0 then strftime(said, '%Y-%m-%dT00:00:00Z') end cutoff from y"""
)
def statement_dates(spark, d):
    """What is known of each statement's day: precision of its range, upload, bound, ordinal years, yearless reading and cutoff."""
    o = read(spark, d, "orders")
    said, c = F.to_date("o_orderdate"), F.col("o_custkey")
    earliest = F.date_sub(said, (c % 400).cast("int"))
    up = rc.upload_date(F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyyMMdd")))
    cutoff = F.when(F.col("o_orderkey") % 5 == 0, rc.to_utc(said.cast("string")))
    return o.select(
        F.col("o_orderkey").alias("id"), rc.date_precision(earliest, said).alias("precision_"), up.alias("uploaded"), F.coalesce(up, earliest).alias("bound"), r6(rc.years_since_one(said)).alias("ordinal_years"),
        rc.yearless((c % 12 + 1).cast("int"), (c % 31 + 1).cast("int"), said).alias("yearless"), cutoff.alias("cutoff"),
    )


@query(
    """with e as (select event_id id, ts, event_id % 4 k from events) select id, case k when 0 then strftime(ts, '%Y-%m-%dT%H:%M:%SZ') when 1 then strftime(ts, '%Y-%m-%d %H:%M:%S') when 2 then strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00' else strftime(ts, '%d/%m/%Y') end raw,
 case k when 0 then strftime(ts, '%Y-%m-%dT%H:%M:%SZ') when 1 then strftime(ts, '%Y-%m-%dT%H:%M:%SZ') when 2 then strftime(ts - interval 2 hour, '%Y-%m-%dT%H:%M:%SZ') end utc from e"""
)
def utc_times(spark, d):
    """Moments of several spellings in UTC; what is none is null."""
    form = lambda f: F.date_format("ts", f)
    k = F.col("event_id") % 4
    raw = F.when(k == 0, form("yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 1, form("yyyy-MM-dd HH:mm:ss")).when(k == 2, F.concat(form("yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))).otherwise(form("dd/MM/yyyy"))
    return read(spark, d, "events").select(F.col("event_id").alias("id"), raw.alias("raw"), rc.to_utc(raw).alias("utc"))
