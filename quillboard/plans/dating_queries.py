"""Queries over dates in texts and over the daters' proposals, each with its SQL.

Orders stand for recordings and their lines for daters; descriptions and excerpts are
written from the rows' own days, in the spellings that pages use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillboard.functions import dategrammar as dg
from quillboard.operators import dating as dn
from quillboard.plans.registry import query
from quillboard.sources.tables import read

TALK = "We met in town today, and spoke of rates."


def _recordings(spark, d) -> DataFrame:
    o, k = read(spark, d, "orders"), F.col("o_orderkey")
    base = F.to_date("o_orderdate")
    own = F.when(k % 5 != 0, F.date_add(base, (k % 3).cast("int")))
    written = F.date_format(base, "MMMM d, yyyy")
    return o.select(
        k.alias("recording"), base.alias("base"), own.alias("own_date"), F.when(own.isNotNull(), F.when(k % 17 == 0, "stated_in_page").otherwise("youtube_upload_date")).alias("own_basis"),
        F.when(k % 25 != 0, F.date_add(base, 20)).alias("fetched"),
        F.when(k % 6 == 0, F.concat(F.lit("Recorded in town on "), written, F.lit(". Enjoy"))).when(k % 6 == 1, F.concat(F.lit("Uploaded "), written)).alias("description"),
        F.lit(TALK).alias("text"),
        F.when(k % 49 == 0, F.array(F.year(base) - 1)).when(k % 7 == 0, F.array(F.year(base))).otherwise(F.array().cast("array<int>")).alias("named_years"),
        F.when(k % 8 == 0, F.array(base)).alias("shown"),
    )


def _proposals(spark, d) -> DataFrame:
    lines = read(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("s"))
    rows = lines.join(_recordings(spark, d).select("recording", "base"), F.col("l_orderkey") == F.col("recording"))
    p, s = F.col("p"), F.col("s")
    ahead = F.element_at(F.array(*map(F.lit, (0, 0, 0, 1, 2, 9))), (p % 6 + 1).cast("int"))
    undated = (p % 11 == 0) & (p % 33 != 0)
    latest = F.date_add("base", ahead)
    bound = lambda kind: F.array(F.struct(F.lit(kind).alias("kind"), latest.alias("day")))
    return rows.select(
        "recording", F.concat(F.lit("d"), F.col("l_linenumber")).alias("dater"), F.col("l_linenumber").cast("int").alias("place"), "p", "s", "base",
        F.when(p % 11 == 0, "cannot_date").when(p % 4 == 1, "publication_only").otherwise("dated").alias("verdict"),
        F.when(~undated, F.date_sub(latest, (s % 4).cast("int"))).alias("earliest"), F.when(~undated, latest).alias("latest"),
        F.when(undated | (p % 29 == 0), "").otherwise("talk").alias("event"), F.when(p % 31 == 0, 0).otherwise(1).alias("sources"), (s % 9 == 0).alias("reupload"),
        F.when(s % 5 == 0, "met in town ... spoke of rates").when(s % 5 == 1, "never said so").alias("evidence"),
        F.when(s % 13 == 0, bound("floor")).when(s % 13 == 1, bound("ceiling")).alias("bounds"),
    )


def _checks(spark, d) -> DataFrame:
    p, s, form = F.col("p"), F.col("s"), (F.col("p") + F.col("s")) % 4
    rows = _proposals(spark, d).where("latest is not null")
    day = F.date_format("latest", "MMMM d, yyyy")
    excerpt = F.when(form == 0, F.concat(F.lit("held on "), day)).when(form == 1, F.concat(F.lit("live "), day, F.lit(" at 9:30 pm PT"))).when(form == 2, F.concat(F.lit("held in "), F.date_format("latest", "MMM. yyyy"))).otherwise(F.concat(F.lit("posted "), F.date_format("latest", "yyyy-MM-dd"), F.lit("T04:30:00Z")))
    flags = ((p % 10 != 0).alias("cited"), (s % 8 != 0).alias("found"), (p % 3 == 1).alias("published"))
    pages = rows.select("recording", "dater", F.lit("page").alias("route"), excerpt.alias("excerpt"), *flags)
    pins = rows.where(s % 12 == 0).select("recording", "dater", F.lit("pin").alias("route"), F.date_format("earliest", "d MMM yyyy").alias("excerpt"), *flags)
    return pages.union(pins)


R = f"""rec as (select o_orderkey recording, o_orderdate::date base, case when o_orderkey % 5 <> 0 then o_orderdate::date + (o_orderkey % 3)::int end own_date, case when o_orderkey % 5 <> 0 then case when o_orderkey % 17 = 0 then 'stated_in_page' else 'youtube_upload_date' end end own_basis,
 case when o_orderkey % 25 <> 0 then o_orderdate::date + 20 end fetched, case when o_orderkey % 49 = 0 then year(o_orderdate) - 1 when o_orderkey % 7 = 0 then year(o_orderdate) end named_year, case when o_orderkey % 8 = 0 then o_orderdate::date end shown from orders),
 ln as (select l_orderkey recording, l_linenumber::int place, min(l_partkey) p, min(l_suppkey) s from lineitem group by all),
 pr as (select ln.*, 'd' || place dater, rec.* exclude (recording), coalesce(own_date, fetched) bound, p % 11 = 0 and p % 33 <> 0 undated, base + [0, 0, 0, 1, 2, 9][p % 6 + 1] l0, case when p % 11 = 0 then 'cannot_date' when p % 4 = 1 then 'publication_only' else 'dated' end verdict from ln join rec using (recording)),
 p2 as (select * exclude (l0), case when not undated then l0 end latest, case when not undated then l0 - (s % 4)::int end earliest, case when undated or p % 29 = 0 then '' else 'talk' end event from pr),
 sp as (select recording, place, 'page' route, case when (p + s) % 4 = 2 then date_trunc('month', latest)::date when verdict = 'publication_only' and (p + s) % 4 = 1 then latest + 1 else latest end lo,
 case when (p + s) % 4 = 2 then last_day(latest) when verdict = 'publication_only' and (p + s) % 4 = 1 then latest + 1 else latest end hi, p % 3 = 1 or (p + s) % 4 = 3 pub from p2 where latest is not null and p % 10 <> 0 and s % 8 <> 0 and ((p + s) % 4 <> 3 or verdict = 'publication_only')
 union all select recording, place, 'pin', earliest, earliest, p % 3 = 1 from p2 where latest is not null and s % 12 = 0 and p % 10 <> 0 and s % 8 <> 0),
 ea as (select *, case when undated and event <> '' or not undated and verdict = 'cannot_date' and event <> '' or not undated and verdict = 'cannot_date' and latest is not null then 'invalid_proposal' when verdict <> 'cannot_date' and (event = '' or p % 31 = 0 or s % 13 = 0 and earliest < latest) then 'invalid_proposal' when verdict = 'cannot_date' then 'cannot_date'
 when verdict = 'publication_only' and s % 9 = 0 then 'reupload_publication_only' when bound is null then 'no_upper_bound' when latest > bound then 'after_upper_bound' end early from p2),
 s1 as (select sp.* from sp join ea using (recording, place) where early is null and (route = 'pin' or lo >= earliest and hi <= latest) union all select recording, place, 'description', base, base, false from ea where early is null and recording % 6 = 0 and base < bound and base between earliest and latest),
 pn as (select recording, place, min(lo) pin from s1 join ea using (recording, place) where route = 'pin' and lo between earliest and latest group by all),
 a1 as (select ea.*, pin, pin is not null and verdict = 'dated' pinned, exists (select 1 from s1 where s1.recording = ea.recording and s1.place = ea.place and route <> 'pin') supported, early is null and s % 5 <> 1 eligible from ea left join pn on pn.recording = ea.recording and pn.place = ea.place),
 a2 as (select * exclude (earliest, latest), case when pinned then pin else earliest end earliest, case when pinned then pin else latest end latest from a1),
 u as (select s1.* from s1 join a2 using (recording, place) where (route <> 'pin' or pinned) and (not pinned or pin between lo and hi)),
 w as (select recording, place, count(*) n, count(*) filter (latest between lo and hi) showing, bool_and(pub) filter (latest between lo and hi) pubs, bool_or(lo = earliest) ev from u join a2 using (recording, place) group by all),
 asd as (select recording, dater, place, verdict, earliest, latest, event, eligible, supported, pinned, coalesce(early, case when coalesce(n, 0) = 0 then case when s % 5 = 1 then 'transcript_evidence_not_found' else 'no_confirming_source' end when showing = 0 then 'latest_day_unsourced' end) reason, coalesce(pubs, false) pubs, coalesce(ev, false) ev, own_date, own_basis, bound, named_year, shown from a2 left join w using (recording, place)),
 az as (select *, reason is null confirmed, reason is null and (verdict = 'publication_only' or pubs) publication_day from asd)"""


@query(
    """with o as (select o_orderkey id, o_orderdate::date d, o_orderkey % 5 k from orders), f as (select id, d, k, case k when 0 then strftime(d, '%Y-%m-%d') || 'T23:30:00-08:00' when 1 then monthname(d) || ' ' || day(d) || ', ' || year(d) || ' at 11:15 pm ET' when 2 then day(d) || 'th of ' || strftime(d, '%b') || ' ' || year(d)
 when 3 then strftime(d, '%b') || '. 3-9, ' || year(d) else monthname(d) || ' ' || year(d) end w from o),
 s as (select id, 7 at_, 7 + len(w) end_, w, case when k = 3 then make_date(year(d), month(d), 3) when k = 4 then date_trunc('month', d)::date else d end lo, case when k = 3 then make_date(year(d), month(d), 9) when k = 4 then last_day(d) else d end hi, k in (0, 1) later from f
 union all select id, 7 + len(w) + 12, 7 + len(w) + 22, strftime(d + 40, '%Y-%m-%d'), d + 40, d + 40, false from f)
 select id, at_ "at", end_ "end", w "text", lo, hi, lo + later::int utc_lo, hi + later::int utc_hi, false utc_stamp from s"""
)
def date_spans(spark, d):
    """Dates that a note names, by place: days, ranges, months, times in zones, and days that no calendar has."""
    day, k = F.to_date("o_orderdate"), F.col("o_orderkey") % 5
    form = lambda f: F.date_format(day, f)
    w = F.when(k == 0, F.concat(form("yyyy-MM-dd"), F.lit("T23:30:00-08:00"))).when(k == 1, F.concat(form("MMMM d, yyyy"), F.lit(" at 11:15 pm ET"))).when(k == 2, F.concat(form("d"), F.lit("th of "), form("MMM yyyy"))).when(k == 3, F.concat(form("MMM"), F.lit(". 3-9, "), form("yyyy"))).otherwise(form("MMMM yyyy"))
    note = F.concat(F.lit("Spoken "), w, F.lit("; not 1999, "), F.date_format(F.date_add(day, 40), "yyyy-MM-dd"), F.lit(" nor 2024-13-02"))
    return read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.explode(dg.dated_spans(note)).alias("s")).select("id", "s.*")


@query(
    """with o as (select o_orderkey id, o_orderdate::date d, o_custkey c from orders), k as (select *, id % 7 k, case when id % 10 <> 0 then d + (c % 3)::int end bound from o)
 select id, case when k in (0, 1) and d < bound then d when k = 4 and d + 1 < bound then d + 1 end "day", case when k = 6 then 'no_description' when k in (3, 5) then 'no_full_day' when k = 2 then 'several_days' when bound is null then 'no_upper_bound' when case when k = 4 then d + 1 else d end >= bound then 'not_before_bound' end why from k"""
)
def description_days(spark, d):
    """The one day that a description names, with cues, links, several days and a publication's time in UTC."""
    day, k = F.to_date("o_orderdate"), F.col("o_orderkey") % 7
    w = F.date_format(day, "MMMM d, yyyy")
    text = lambda *parts: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])
    note = F.when(k == 0, text("A talk given on ", w, ".")).when(k == 1, text("Born 3 May 1950. The talk of ", w, ", and again ", F.date_format(day, "yyyy-MM-dd"))).when(k == 2, text(w, " and 4 March 1901"))
    note = note.when(k == 3, text("Premiered ", w)).when(k == 4, text("Posted ", w, " at 10:00 pm CT")).when(k == 5, text("see https://x.org/", F.date_format(day, "yyyy-MM-dd"), "/talk"))
    bound = F.when(F.col("o_orderkey") % 10 != 0, F.date_add(day, (F.col("o_custkey") % 3).cast("int")))
    return read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), dg.only_day(note, k == 4, bound).alias("o")).select("id", "o.day", "o.why")


@query(f"with {R} select recording, dater, verdict, earliest, latest, eligible, confirmed, supported, pinned, publication_day, confirmed and ev from_evidenced, reason from az")
def dating_assessed(spark, d):
    """Each dater's proposal by itself, with the reason that it waits for."""
    got = dn.assess_proposals(_proposals(spark, d), _recordings(spark, d), _checks(spark, d))
    return got.select("recording", "dater", "verdict", "earliest", "latest", "eligible", "confirmed", "supported", "pinned", "publication_day", "from_evidenced", "reason")


@query(
    f"""with {R}, su as (select * from az where confirmed), inn as (select recording, latest il, place ip from su qualify row_number() over (partition by recording order by latest, latest - earliest, place) = 1), pp as (select recording, count(distinct latest) npd, min(latest) pd, min(place) pfirst from su where pinned group by recording),
 g0 as (select su.recording, count(*) n, count(distinct latest) nd, count(*) > 1 and bool_and(il between earliest and latest) fits, any_value(ip) ip, min(place) first_, any_value(npd) npd, any_value(pfirst) pfirst, count(*) filter (not pinned) nrest, bool_and(publication_day and latest > pd) filter (not pinned) later from su join inn using (recording) left join pp using (recording) group by su.recording),
 g1 as (select *, fits and nd > 1 refines, not (fits and nd > 1) and nd > 1 and coalesce(npd, 0) = 1 and nrest > 0 and coalesce(later, false) outranks from g0), g as (select *, case when fits then ip when outranks then pfirst else first_ end lp from g1),
 al as (select recording, count(*) n_all, bool_and(eligible) elig, max(latest) last_, min(latest) first_day, min(earliest) from_, count(distinct reason) nreasons, count(*) filter (reason is null) nnull, min(reason) one_reason, any_value(own_date) own_date, any_value(own_basis) own_basis, any_value(bound) bound, any_value(named_year) named_year, any_value(shown) shown from az group by recording),
 ld as (select g.recording, su.dater lead, su.latest ll, su.earliest le, su.publication_day lpub, su.event levent from g join su on su.recording = g.recording and su.place = g.lp),
 ag as (select az.recording, string_agg(az.dater, ',' order by az.place) filter (not lpub and not supported) overruled, count(*) filter (lpub or supported) blocking from az join g using (recording) join ld using (recording) where eligible and az.place <> lp and not (ll between az.earliest and az.latest) and not (outranks and confirmed and not pinned) group by az.recording),
 rf as (select su.recording, string_agg(su.dater, ',' order by su.place) refined from su join g using (recording) join ld using (recording) where refines and latest <> ll or outranks and not pinned group by su.recording),
 nm as (select az.recording, az.event from az join al using (recording) where az.latest = last_ qualify row_number() over (partition by az.recording order by place) = 1),
 m as (select al.*, lead, ll, le, levent, refined, overruled, coalesce(blocking, 0) blocking, g.nd, coalesce(refines, false) refines, coalesce(outranks, false) outranks, g.recording is not null found, g.recording is null and n_all >= 2 and elig and coalesce(last_ - first_day <= 7, false) agreed, nm.event nevent from al left join g using (recording) left join ld using (recording) left join ag using (recording) left join rf using (recording) left join nm using (recording)),
 x as (select *, case when found then ll when agreed then last_ end dd, case when found then le when agreed then from_ end ff from m),
 y as (select *, case when found and (nd > 1 and not refines and not outranks or blocking > 0) then 'dater_disagreement' when agreed and (last_ = bound or last_ = shown) then 'agreement_on_shared_input' when dd is not null and named_year is not null and not (named_year between year(ff) and year(dd)) then 'strong_year_conflict'
 when dd is not null and own_basis = 'stated_in_page' and dd = own_date then 'own_date_stated' when dd is not null and own_basis = 'stated_in_page' then 'stated_date_contradicted' when dd is null then case when nreasons = 1 and nnull = 0 then one_reason else 'no_confirmation' end end reason from x)
 select recording, case when reason is not null then 'queue' when own_date = dd then 'check' else 'override' end outcome, reason, case when reason is null then dd end "day", case when reason is null then ff end earliest, case when reason is null then lead end lead, case when reason is null then case when found then 'source_confirmed' else 'two_agent_agreement' end end "method",
 case when reason is null then case when found then levent else nevent end end event, case when reason is null then coalesce(refined, '') end refined, case when reason is null then coalesce(overruled, '') end overruled, case when reason is null and not found then last_ - first_day end days_apart from y"""
)
def dating_merged(spark, d):
    """Per recording: the day that its daters' proposals leave, as an override, a check or a queue row with its reason."""
    recordings = _recordings(spark, d)
    return dn.merge_proposals(dn.assess_proposals(_proposals(spark, d), recordings, _checks(spark, d)), recordings)
