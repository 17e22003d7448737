"""Queries of gates over the board: venues, judges' leans, rejections, own channels, contracts, copies cut short."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillboard.operators import checks as ck, intervals as iv, rater as rt, screens as sc
from quillboard.operators.rater import r6
from quillboard.plans.board_queries import VERDICT, _gap_sql
from quillboard.plans.oracles import BOARD, G
from quillboard.plans.registry import query
from quillboard.sources.tables import first_ratings, ratings, read

N = 200
VOTED = "vt as (select rec, venue, count(*) k from g where run = 0 group by all), vb as (select rec, case when count(*) filter (k = best) = 1 then min(venue) filter (k = best) end venue from (select *, max(k) over (partition by rec) best from vt) group by rec)"


def _recordings(spark, d) -> DataFrame:
    """Blinded recordings of the calibrated board with the venue that their judges agree on."""
    g = first_ratings(spark, d)
    voted = rt.venue_vote(g).select("rec", F.when(F.col("agreed"), F.col("venue")).alias("venue"))
    return rt.consensus(rt.calibrated(g)).where("mode = 'F'").join(voted, "rec")


@query(
    f"""with {G}, {VOTED}, r as (select distinct person, g.rec, vb.venue from g join vb on vb.rec = g.rec where mode = 'F' and run = 0), k as (select * from r where venue is not null), pv as (select venue, count(*) n, count(distinct person) people from k group by venue), pp as (select person, count(distinct venue) k from k group by person),
 o as (select count(*) people, count(*) filter (k >= 2) mixed from pp), re as (select venue || ':rows' x from pv where n < 20 union all select venue || ':people' from pv where people < 3 union all select 'mixed_share' from o where mixed < 0.8 * people)
 select (select count(*) from re) = 0 ok, (select count(*) from pv) venues, people, round(mixed / people, 6) mixed_share, coalesce((select string_agg(x, ',' order by x) from re), '') reasons from o"""
)
def venue_gate(spark, d):
    """Whether the blinded recordings bear an adjustment for venues: rows and people of each, and people with two."""
    return rt.venue_gate(_recordings(spark, d), least=20)


@query(
    f"""{BOARD}, {VOTED}, c as (select person, con.rec, vb.venue, overall, greatest(coverage, 0.05) w from con join vb on vb.rec = con.rec where mode = 'F'), fb as (select person, count(*) n, round(sum(overall * w) / sum(w), 6) f from c group by person having count(*) >= 5), rk as (select *, row_number() over (order by f desc, person) rank from fb),
 vs as (select distinct venue from c semi join rk using (person) where venue is not null), x as (select vs.venue, rk.person, any_value(rank) rank, any_value(f) f, count(c.rec) filter (c.venue is distinct from vs.venue) keep, count(c.rec) filter (c.venue = vs.venue) gone, round(sum(overall * w) filter (c.venue is distinct from vs.venue) / sum(w) filter (c.venue is distinct from vs.venue), 6) o from vs cross join rk join c on c.person = rk.person group by vs.venue, rk.person),
 s as (select *, row_number() over (partition by venue order by rank) b, row_number() over (partition by venue order by o desc, rank) a, round(abs(o - f), 1) sh from x where keep >= 5), q as (select venue, count(*) m, count(*) filter (a <> b) ch, sum((a - b) * (a - b)) d2, max(sh) ms, arg_min(person, (-sh, rank)) mp, round(avg(sh), 2) av from s group by venue)
 select x.venue, sum(gone)::bigint dropped, count(*) filter (gone > 0) people, coalesce(any_value(m), 0) still_ranked, count(*) filter (keep < 5) below_floor, coalesce(any_value(ch), 0) changing, any_value(case when m >= 3 then round(1 - 6 * d2 / (m * (m * m - 1)), 3) end) rho, any_value(ms) max_shift, any_value(mp) max_shift_person, any_value(av) mean_shift from x left join q on q.venue = x.venue group by x.venue"""
)
def venue_sensitivity(spark, d):
    """The board without each venue: who falls below the floor, whose rank changes, Spearman's correlation and shifts."""
    return rt.venue_sensitivity(_recordings(spark, d))


@query(
    f"""with {G}, p as (select judge, round(count(*) filter (share < 5) / count(*), 4) r from g group by judge), h as (select judge, r from p order by r desc, judge limit 1), l as (select judge, r from p order by r, judge limit 1)
 select (select count(*) from p) >= 2 and h.r > 0 and (l.r = 0 or h.r / l.r >= 3) skewed, h.judge highest, l.judge lowest, h.r high_rate, l.r low_rate, case when l.r > 0 then round(h.r / l.r, 1) end ratio from h, l"""
)
def rejection_skew(spark, d):
    """Whether the filter of little shares rejects one judge's ratings far more often than another's."""
    return rt.rejection_skew(ratings(spark, d), "judge", F.col("share") < 5)


LEAN = f"""{BOARD}, sc as (select person, rec, judge, d1 * 0.4 + d2 * 0.35 + d3 * 0.25 o from cal where mode = 'F'), pl as (select rec from sc group by rec having count(*) = (select count(distinct judge) from sc)), ga as (select person, rec, judge, o - (sum(o) over (partition by rec) - o) / (count(*) over (partition by rec) - 1) x from sc semi join pl using (rec))"""


@query(
    " union all ".join(
        f"""(select '{j}' judge, a left_n, b right_n, round(gap, 6) estimate, round(lo, 6) lo, round(hi, 6) hi, {VERDICT.format(b="2")} verdict from ({LEAN}, {_gap_sql(f"select case when substr(person, 7)::int % 2 = 0 then 'a' else 'b' end side, person cl, x as value from ga where judge = '{j}'", N)} select gw.*, ge.* from gw, ge))"""
        for j in "ANR"
    )
)
def judge_lean_sides(spark, d):
    """Per judge: its calibrated score less the other judges' mean, people of even number less the others, with a 90 % interval by people and a verdict at 2 points."""
    score = sum((F.col(x) * w for x, w in rt.WEIGHTS.items()), F.lit(0.0))
    gaps = rt.gaps_to_others(rt.calibrated(first_ratings(spark, d)).where("mode = 'F'").select("person", "rec", "judge", score.alias("x")))
    side = F.when(F.substring("person", 7, 9).cast("int") % 2 == 0, "a").otherwise("b")
    ci = iv.cluster_gap(gaps.select("judge", side.alias("side"), "person", F.col("x").alias("value")), "person", N, by=["judge"])
    judges = spark.range(1).select(F.explode(F.array(*map(F.lit, "ANR"))).alias("judge"))
    verdict = F.when((F.col("lo") > -2) & (F.col("hi") < 2), "PASS").when((F.col("lo") >= 2) | (F.col("hi") <= -2), "FAIL").otherwise("INCONCLUSIVE")
    none = F.lit(0).cast("long")
    return judges.join(ci, "judge", "left").select("judge", F.coalesce("a", none).alias("left_n"), F.coalesce("b", none).alias("right_n"), r6(F.col("gap")).alias("estimate"), r6(F.col("lo")).alias("lo"), r6(F.col("hi")).alias("hi"), verdict.alias("verdict"))


@query(
    """with o as (select o_orderkey k, o_custkey c, o_totalprice / 1000 x, case when o_custkey % 4 <> 0 then 'UC' || (o_custkey % 9) end ch, o_orderkey % 3 m from orders), w as (select *, case m when 0 then ['UC' || (c % 9), 'UCx'] when 1 then ['UC' || (c % 5)] end own from o)
 select k id, case when not coalesce(list_contains(own, ch), false) then round(x, 6) end density, case when coalesce(list_contains(own, ch), false) then round(x, 6) end measured, case when coalesce(list_contains(own, ch), false) then 'skipped_own_channel' end "check" from w"""
)
def own_channel(spark, d):
    """Densities of names, left out of the gate for uploads of the person's own channels, with the measured value beside."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    channel = F.when(c % 4 != 0, F.concat(F.lit("UC"), (c % 9).cast("string")))
    own = F.when(k % 3 == 0, F.array(F.concat(F.lit("UC"), (c % 9).cast("string")), F.lit("UCx"))).when(k % 3 == 1, F.array(F.concat(F.lit("UC"), (c % 5).cast("string"))))
    rows = read(spark, d, "orders").select(k.alias("id"), sc.own_channel_density(F.round(F.col("o_totalprice") / 1000, 6), channel, own).alias("d"))
    return rows.select("id", "d.density", "d.measured", "d.check")


@query(
    """with o as (select o_orderkey k, o_orderstatus s, o_custkey c from orders) select k id, substr(sha256('{"blinding":{"token":"[SUBJECT]","wordlist":null},"contract_version":2,"judges":["a","b",' || c || '],"study":"é-' || s || '"}'), 1, 16) contract_id from o"""
)
def contract_ids(spark, d):
    """The id of each contract, whatever the order in which its components are written."""
    k, c, s = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    one = F.format_string('{"study": "é-%s", "judges": ["a", "b", %d], "contract_version": 2, "blinding": {"wordlist": null, "token": "[SUBJECT]"}}', s, c)
    two = F.format_string('{"blinding":{"token":"[SUBJECT]",  "wordlist":null},"contract_version":2,\n"judges":["a","b",%d],"study":"\\u00e9-%s"}', c, s)
    return read(spark, d, "orders").select(k.alias("id"), ck.contract_id(F.when(k % 2 == 0, one).otherwise(two)).alias("contract_id"))


@query("""select p_partkey id, p_size / 50.0 containment, p_size * 100 as "words", (p_partkey % 7) * 900 as "seconds", coalesce(p_size / 50.0 < 0.95 and (p_partkey % 7) > 0 and p_size * 100 / ((p_partkey % 7) * 900 / 60.0) < 90, false) truncated from part""")
def truncated_copies(spark, d):
    """Copies that hold less than the whole of the other and run so slowly that they may be cut short."""
    size, key = F.col("p_size"), F.col("p_partkey")
    rows = read(spark, d, "part").select(key.alias("id"), (size / 50.0).alias("containment"), (size * 100).alias("words"), (key % 7 * 900).alias("seconds"))
    return rows.withColumn("truncated", sc.truncation(F.col("containment"), F.col("words"), F.col("seconds")))
