"""Queries of the board: intervals, gates, sensitivities and the raters' agreement."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillboard.functions import special as sp
from quillboard.operators import intervals as iv, rater as rt
from quillboard.operators.rater import r6
from quillboard.plans.oracles import BOARD, CAL, CON, G, LONG
from quillboard.plans.registry import ORACLES, query
from quillboard.sources.tables import first_ratings, forecasts, ratings, read

N = 1000
PICK = "(('0x' || substr({h}, 1 + {k} % 4 * 8, 8))::bigint % {n})"


def _ratio_sql(rows: str, n: int, alpha: float, groups: str = "grp") -> str:
    """SQL of ratio_interval over rows (grp, unit, num, den)."""
    lo, hi = int(alpha / 2 * n) + 1, min(int((1 - alpha / 2) * n), n - 1) + 1
    return f"""u as (select *, row_number() over (partition by grp order by substr(md5(unit::varchar), 1, 2), unit) - 1 at_, count(*) over (partition by grp) units from ({rows})),
 dr as (select u.grp, u.units, i, {PICK.format(h="md5(u.grp::varchar || ':' || i::varchar || ':' || (u.at_ // 4)::varchar)", k="u.at_", n="u.units")} pick from u, range({n}) r(i)),
 mm as (select dr.grp, dr.units, i, sum(num) / sum(den) m from dr join u on u.grp = dr.grp and u.at_ = dr.pick group by all), ci as (select grp, units, list(m order by m) l from mm group by all), ci2 as (select grp, units, l[{lo}] lo, l[{hi}] hi from ci)"""


def _gap_sql(rows: str, n: int) -> str:
    """SQL of cluster_gap over rows (side, cl, value)."""
    lo, hi = int(0.05 * n) + 1, min(int(0.95 * n), n - 1) + 1
    return f"""rw as ({rows}), vv as (select *, row_number() over (partition by side, cl order by value) - 1 v from rw), sz as (select side, cl, count(*) n, row_number() over (partition by side order by cl) - 1 c, count(*) over (partition by side) clusters from rw group by side, cl),
 sl as (select side, i, c slot, {PICK.format(h="md5(side || ':' || i::varchar || ':' || c::varchar)", k="0", n="clusters")} c from sz, range({n}) r(i)),
 pk as (select sl.side, i, slot, sz.cl, sz.n, unnest(range(sz.n)) k from sl join sz on sz.side = sl.side and sz.c = sl.c),
 pv as (select side, i, cl, {PICK.format(h="md5(side || ':' || i::varchar || ':' || slot::varchar || ':' || (k // 4)::varchar || ':v')", k="k", n="n")} v from pk),
 dm as (select i, avg(value) filter (pv.side = 'a') - avg(value) filter (pv.side = 'b') m from pv join vv on vv.side = pv.side and vv.cl = pv.cl and vv.v = pv.v group by i),
 ge as (select list(m order by m)[{lo}] lo, list(m order by m)[{hi}] hi from dm), gw as (select count(*) filter (side = 'a') a, count(*) filter (side = 'b') b, avg(value) filter (side = 'a') - avg(value) filter (side = 'b') gap from rw)"""


HALO = f"""with {G}, {LONG}, {CAL}, o as (select person, rec, judge, avg(d1 * 0.4 + d2 * 0.35 + d3 * 0.25) filter (mode = 'O') - avg(d1 * 0.4 + d2 * 0.35 + d3 * 0.25) filter (mode = 'F') x from cal group by all), h as (select * from o where x is not null)"""
VERDICT = "case when lo > -{b} and hi < {b} then 'PASS' when lo >= {b} or hi <= -{b} then 'FAIL' else 'INCONCLUSIVE' end"


def _blinded(spark, d):
    return rt.consensus(rt.calibrated(first_ratings(spark, d)).where("mode = 'F'"))


@query(
    f"""{BOARD}, bw as (select person, rec, overall * greatest(coverage, 0.05) num, greatest(coverage, 0.05) den from con where mode = 'F'), {_ratio_sql("select person grp, rec unit, num, den from bw", N, 0.05)}, pt as (select person, sum(num) / sum(den) overall from bw group by person)
 select person, units n, round(overall, 6) overall, round(lo, 6) lo, round(hi, 6) hi, round(log10(list_reduce(list_prepend(1.0::double, [((units - 1 + i) / i)::double for i in range(1, units + 1)]), lambda a, b: a * b)), 4) log10_resamples from ci2 join pt on pt.person = ci2.grp"""
)
def board_intervals(spark, d):
    """The coverage-weighted calibrated board score of each person with its 95 % interval over 1000 resamples of recordings."""
    w = F.greatest("coverage", F.lit(rt.LEAST_COVERAGE))
    rows = _blinded(spark, d).select("person", "rec", (F.col("overall") * w).alias("num"), w.alias("den"))
    ci = iv.ratio_interval(rows, "person", "rec", N)
    point = rows.groupBy("person").agg(r6(F.sum("num") / F.sum("den")).alias("overall"))
    return ci.join(point, "person").select("person", F.col("units").alias("n"), "overall", r6(F.col("lo")).alias("lo"), r6(F.col("hi")).alias("hi"), F.round(F.log10(iv.distinct_resamples(F.col("units"))), 4).alias("log10_resamples"))


def _halo(spark, d):
    """Calibrated open less blinded score of each (recording, judge) that has both."""
    score = sum((F.col(x) * w for x, w in rt.WEIGHTS.items()), F.lit(0.0))
    per = rt.calibrated(first_ratings(spark, d)).groupBy("person", "rec", "judge").agg(F.avg(F.when(F.col("mode") == "O", score)).alias("o"), F.avg(F.when(F.col("mode") == "F", score)).alias("b"))
    return per.where("o is not null and b is not null").withColumn("x", F.col("o") - F.col("b"))


@query(
    f"""{HALO}, {_ratio_sql("select person grp, rec unit, sum(x) num, count(x)::double den from h group by all", N, 0.05)}, jd as (select person, judge, avg(x) x from h group by all), js as (select person, max(x) - min(x) gap, count(*) judges, bool_and(x > 0) or bool_and(x < 0) same from jd group by person),
 w as (select person, count(*) pairs, avg(x) halo from h group by person), z as (select w.person, pairs, units, halo, lo, hi, case when judges >= 2 then gap end gap, case when judges >= 2 then same end same, lo > 0 or hi < 0 clear from w join js on js.person = w.person join ci2 on ci2.grp = w.person)
 select person, pairs, units, round(halo, 6) halo, round(lo, 6) lo, round(hi, 6) hi, round(gap, 6) judge_gap, same same_sign, clear and coalesce(same, false) significant, case when not clear then 'spans zero' when same is null then 'one judge' when not same then 'judges disagree' else 'agreed' end note from z"""
)
def halo_agreement(spark, d):
    """Per person: halo with its interval, the judges' gap and whether they agree in sign; significant only if they do."""
    h = _halo(spark, d)
    ci = iv.ratio_interval(h.groupBy("person", "rec").agg(F.sum("x").alias("num"), F.count("x").cast("double").alias("den")), "person", "rec", N)
    by = h.groupBy("person", "judge").agg(F.avg("x").alias("x")).groupBy("person").agg((F.max("x") - F.min("x")).alias("gap"), F.count("*").alias("judges"), (F.bool_and(F.col("x") > 0) | F.bool_and(F.col("x") < 0)).alias("same"))
    whole = h.groupBy("person").agg(F.count("*").alias("pairs"), F.avg("x").alias("halo")).join(by, "person").join(ci, "person")
    agree = F.when(F.col("judges") >= 2, F.col("same"))
    clear = (F.col("lo") > 0) | (F.col("hi") < 0)
    note = F.when(~clear, "spans zero").when(agree.isNull(), "one judge").when(~agree, "judges disagree").otherwise("agreed")
    return whole.select("person", "pairs", "units", r6(F.col("halo")).alias("halo"), r6(F.col("lo")).alias("lo"), r6(F.col("hi")).alias("hi"), r6(F.when(F.col("judges") >= 2, F.col("gap"))).alias("judge_gap"), agree.alias("same_sign"), (clear & F.coalesce(agree, F.lit(False))).alias("significant"), note.alias("note"))


@query(
    f"""{HALO}, {_gap_sql("select case when substr(person, 7)::int % 2 = 0 then 'a' else 'b' end side, person cl, x as value from h", 200)}
 select a, b, round(gap, 6) gap, round(lo, 6) lo, round(hi, 6) hi, {VERDICT.format(b="3")} verdict from gw, ge"""
)
def halo_lean_gate(spark, d):
    """Halo of persons of even number less that of the others, people and then their pairs resampled, against 3 points."""
    side = F.when(F.substring("person", 7, 9).cast("int") % 2 == 0, "a").otherwise("b")
    g = iv.cluster_gap(_halo(spark, d).select(side.alias("side"), "person", F.col("x").alias("value")), "person", 200)
    return g.select("a", "b", r6(F.col("gap")).alias("gap"), r6(F.col("lo")).alias("lo"), r6(F.col("hi")).alias("hi"), iv.equivalence(F.col("lo"), F.col("hi"), 3).alias("verdict"))


@query(
    f"""with s0 as (select user_id person, case when value > 100 then 100.0 else 0.0 end::double x from events), {_gap_sql("select case when person % 2 = 0 then 'a' else 'b' end side, person cl, x as value from s0", 100)}
 select a, b, round(gap, 6) gap, round(lo, 6) lo, round(hi, 6) hi, {VERDICT.format(b="5")} verdict from gw, ge"""
)
def search_gate(spark, d):
    """Rate of forecasts worth over 100, even users less odd ones in points: people resampled, then their units."""
    x = F.when(F.col("value") > 100, 100.0).otherwise(0.0)
    rows = forecasts(spark, d).select(F.when(F.col("person") % 2 == 0, "a").otherwise("b").alias("side"), "person", x.alias("value"))
    g = iv.cluster_gap(rows, "person", 100)
    return g.select("a", "b", r6(F.col("gap")).alias("gap"), r6(F.col("lo")).alias("lo"), r6(F.col("hi")).alias("hi"), iv.equivalence(F.col("lo"), F.col("hi"), 5).alias("verdict"))


@query(
    f"""with {G}, c as (select rec, judge, mode, arg_max(d1, run) - arg_min(d1, run) x from g group by all having max(run) > 0), {_ratio_sql("select judge grp, rec || mode unit, x num, 1.0::double den from c", 500, 0.1)}, m as (select judge, avg(x) drift from c group by judge),
 v as (select grp judge, units n, drift, lo, hi, {VERDICT.format(b="2")} verdict from ci2 join m on m.judge = ci2.grp)
 select judge, n, round(drift, 6) drift, round(lo, 6) lo, round(hi, 6) hi, verdict, (select case when bool_or(verdict = 'FAIL') then 'FAIL' when bool_and(verdict = 'PASS') then 'PASS' else 'INCONCLUSIVE' end from v) overall from v"""
)
def drift_verdicts(spark, d):
    """Latest less earliest run of each repeated cell by judge, cells resampled, against 2 points; and the judges' verdicts together."""
    c = ratings(spark, d).groupBy("rec", "judge", "mode").agg((F.max_by("d1", "run") - F.min_by("d1", "run")).alias("num"), F.max("run").alias("last")).where("last > 0")
    c = c.select("judge", F.concat(F.col("rec").cast("string"), F.col("mode")).alias("unit"), "num", F.lit(1.0).alias("den"))
    v = iv.ratio_interval(c, "judge", "unit", 500, 0.1).join(c.groupBy("judge").agg(F.avg("num").alias("drift")), "judge").withColumn("verdict", iv.equivalence(F.col("lo"), F.col("hi"), 2))
    whole = v.agg(iv.combined("verdict").alias("overall"))
    return v.crossJoin(F.broadcast(whole)).select("judge", F.col("units").alias("n"), r6(F.col("drift")).alias("drift"), r6(F.col("lo")).alias("lo"), r6(F.col("hi")).alias("hi"), "verdict", "overall")


@query(
    f"""with {G}, c as (select rec, judge, avg(d1) x from g where run = 0 group by all), p as (select count(distinct judge) k from c), f as (select * from c where rec in (select rec from c, p group by rec having count(*) = any_value(k))),
 a as (select *, avg(x) over (partition by rec) u, avg(x) over (partition by judge) r, avg(x) over () m from f), s as (select count(distinct rec) n, count(distinct judge) k, sum((u - m) * (u - m)) ssu, sum((r - m) * (r - m)) ssr, sum((x - u - r + m) * (x - u - r + m)) sse from a),
 t as (select n, k, ssu / (n - 1) msu, ssr / (k - 1) msr, sse / ((n - 1) * (k - 1)) mse from s)
 select n, k, round((msu - mse) / (msu + (k - 1) * mse + k * (msr - mse) / n), 6) icc21, round((msu - mse) / (msu + (k - 1) * mse), 6) icc31 from t"""
)
def icc_two_way(spark, d):
    """Agreement and consistency of all judges over recordings that all of them rated, whatever the panel's size."""
    return iv.two_way_icc(ratings(spark, d).where("run = 0"), "rec", "judge", "d1")


@query(
    f"""with {G}, c as (select rec, judge, mode, max(d1) filter (run = 0) x, max(d1) filter (run = 1) y from g where run < 2 group by all), f as (select rec || judge || mode u, x, 0 t from c where y is not null union all select rec || judge || mode, y, 1 from c where y is not null),
 a as (select *, avg(x) over (partition by u) um, avg(x) over (partition by t) tm, avg(x) over () m from f), s as (select count(distinct u) n, sum((um - m) * (um - m)) ssu, sum((tm - m) * (tm - m)) sst, sum((x - um - tm + m) * (x - um - tm + m)) sse from a)
 select n, round((ssu / (n - 1) - sse / (n - 1)) / (ssu / (n - 1) + sse / (n - 1)), 6) icc31, round(sqrt(sse / (n - 1)), 6) sem from s"""
)
def retest_icc(spark, d):
    """ICC(3,1) of first and second runs, from sums of squares, and the error of one run."""
    c = ratings(spark, d).where("run < 2").groupBy("rec", "judge", "mode").agg(F.max(F.when(F.col("run") == 0, F.col("d1"))).alias("x"), F.max(F.when(F.col("run") == 1, F.col("d1"))).alias("y")).where("y is not null")
    s = c.agg(F.count("*").alias("n"), F.var_samp(F.col("x") + F.col("y")).alias("vs"), F.var_samp(F.col("x") - F.col("y")).alias("vd"))
    return s.selectExpr("n", "round((vs / 2 - vd / 2) / (vs / 2 + vd / 2), 6) icc31", "round(sqrt(vd / 2), 6) sem")


@query(
    f"""with {G}, m as (select rec, judge, avg(d1) d1, avg(d2) d2, avg(d3) d3 from g where run = 0 group by all), l as (select rec, judge, 'd1' dim, d1 v from m union all select rec, judge, 'd2', d2 from m union all select rec, judge, 'd3', d3 from m),
 p as (select a.dim da, b.dim db, a.judge ja, b.judge jb, corr(a.v, b.v) r from l a join l b on a.rec = b.rec and a.judge < b.judge group by all), h as (select a.dim da, b.dim db, a.judge ja, corr(a.v, b.v) r from l a join l b on a.rec = b.rec and a.judge = b.judge and a.dim < b.dim group by all)
 select kind, count(*) pairs, round(avg(r), 6) mean_r, round(min(r), 6) low, round(max(r), 6) high from (select 'convergent' kind, r from p where da = db union all select 'heterotrait', r from p where da <> db union all select 'same judge', r from h) group by kind"""
)
def trait_matrix(spark, d):
    """Correlations of one trait between judges, of different traits between judges, and of traits within a judge."""
    m = ratings(spark, d).where("run = 0").groupBy("rec", "judge").agg(*[F.avg(x).alias(x) for x in rt.DIMENSIONS])
    wide = m.groupBy("rec").pivot("judge", ["A", "N", "R"]).agg(F.first("d1").alias("d1"), F.first("d2").alias("d2"), F.first("d3").alias("d3"))
    names = [(j, x) for j in "ANR" for x in rt.DIMENSIONS]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    kind = lambda a, b: "same judge" if a[0] == b[0] else "convergent" if a[1] == b[1] else "heterotrait"
    one = wide.agg(F.array(*[F.struct(F.lit(kind(a, b)).alias("kind"), F.corr(f"{a[0]}_{a[1]}", f"{b[0]}_{b[1]}").alias("r")) for a, b in pairs]).alias("p"))
    return one.select(F.explode("p").alias("p")).groupBy("p.kind").agg(F.count("*").alias("pairs"), r6(F.avg("p.r")).alias("mean_r"), r6(F.min("p.r")).alias("low"), r6(F.max("p.r")).alias("high"))


@query(
    f"""with {G}, j as (select judge, avg(d1) m, stddev_samp(d1) s, count(*) n from g where run = 0 group by judge), r as (select judge, avg(v) sd from (select judge, rec, mode, stddev_samp(d1) v from g group by all having count(*) > 1) group by judge)
 select a.judge judge_a, b.judge judge_b, round(a.m - b.m, 6) gap, round((a.m - b.m) / ((ra.sd + rb.sd) / 2), 6) gap_in_noise, round(2.77 * (ra.sd + rb.sd) / 2, 6) lsd, abs(a.m - b.m) > 2.77 * (ra.sd + rb.sd) / 2 resolved from j a join j b on a.judge < b.judge join r ra on ra.judge = a.judge join r rb on rb.judge = b.judge"""
)
def pair_noise(spark, d):
    """Offsets between judges in units of what one judge differs from itself, and the least difference that shows."""
    g = ratings(spark, d)
    noise = g.groupBy("judge", "rec", "mode").agg(F.stddev_samp("d1").alias("v"), F.count("*").alias("k")).where("k > 1").groupBy("judge").agg(F.avg("v").alias("sd"))
    j = g.where("run = 0").groupBy("judge").agg(F.avg("d1").alias("m")).join(noise, "judge")
    a, b = j.select(F.col("judge").alias("judge_a"), F.col("m").alias("ma"), F.col("sd").alias("sa")), j.select(F.col("judge").alias("judge_b"), F.col("m").alias("mb"), F.col("sd").alias("sb"))
    sd, gap = (F.col("sa") + F.col("sb")) / 2, F.col("ma") - F.col("mb")
    return a.join(b, F.col("judge_a") < F.col("judge_b")).select("judge_a", "judge_b", r6(gap).alias("gap"), r6(gap / sd).alias("gap_in_noise"), r6(2.77 * sd).alias("lsd"), (F.abs(gap) > 2.77 * sd).alias("resolved"))  # a row for each judge


@query(
    f"""with {G}, j as (select person, count(distinct rec) n, count(distinct rec) filter (day >= date '1995-01-01') late from g group by person), s as (select stddev_samp(d1) sd from g where run = 0)
 select person, n, late, round(sd * sqrt(1.0 / nullif(late, 0) + 1.0 / nullif(n - late, 0)) * 1.96, 6) threshold from j, s"""
)
def padding_thresholds(spark, d):
    """The difference between a person's late and early recordings that noise alone would not show."""
    g = ratings(spark, d)
    j = g.groupBy("person").agg(F.count_distinct("rec").alias("n"), F.count_distinct(F.when(F.col("day") >= "1995-01-01", F.col("rec"))).alias("late"))
    s = g.where("run = 0").agg(F.stddev_samp("d1").alias("sd"))
    inverse = lambda c: 1.0 / F.nullif(c, F.lit(0))
    return j.crossJoin(F.broadcast(s)).select("person", "n", "late", r6(F.col("sd") * F.sqrt(inverse(F.col("late")) + inverse(F.col("n") - F.col("late"))) * 1.96).alias("threshold"))  # one row


@query(
    f"""with {G}, b as (select judge, avg(d1) m, stddev_samp(d1) sd, count(*) n from g where run = 0 and mode = 'F' group by judge), v as (select judge, venue, avg(d1) m, count(*) n from g where run = 0 and mode = 'O' group by all)
 select v.judge, venue, v.n, round(v.m - b.m, 6) effect, round(b.sd * sqrt(1.0 / v.n + 1.0 / b.n) * 1.96, 6) lsd, abs(v.m - b.m) > b.sd * sqrt(1.0 / v.n + 1.0 / b.n) * 1.96 significant from v join b on b.judge = v.judge"""
)
def variant_effects(spark, d):
    """Open ratings of each venue as variants, less the judge's blinded baseline."""
    g = ratings(spark, d).where("run = 0")
    base = g.where("mode = 'F'").groupBy("judge").agg(F.avg("d1").alias("bm"), F.stddev_samp("d1").alias("sd"), F.count("*").alias("bn"))
    v = g.where("mode = 'O'").groupBy("judge", "venue").agg(F.avg("d1").alias("m"), F.count("*").alias("n")).join(F.broadcast(base), "judge")  # a row for each judge
    lsd = F.col("sd") * F.sqrt(1.0 / F.col("n") + 1.0 / F.col("bn")) * 1.96
    return v.select("judge", "venue", "n", r6(F.col("m") - F.col("bm")).alias("effect"), r6(lsd).alias("lsd"), (F.abs(F.col("m") - F.col("bm")) > lsd).alias("significant"))


@query(
    f"""{BOARD.replace("with g as (", "with g0 as (", 1).replace(", lg as (", ", g as (select * from g0 where rec % 5 <> 0), lg as (", 1)}, b as (select person, round(sum(overall * greatest(coverage, 0.05)) / sum(greatest(coverage, 0.05)), 6) overall, count(*) n from con where mode = 'F' group by person)
 select person, n, overall, row_number() over (order by overall desc, person) as rank from b"""
)
def archival_excluded(spark, d):
    """The board without every fifth recording, calibration fitted anew on what is left."""
    board = rt.board(rt.consensus(rt.calibrated(ratings(spark, d).where("rec % 5 <> 0")).where("mode = 'F'")), 0)
    return board.select("person", "n", "overall", "rank")


@query(
    f"""{BOARD}, r as (select distinct p_brand person from part), md(mode) as (values ('F'), ('O')), sp as (select person, mode, avg(s) spread from (select person, rec, mode, unnest([max(d1) - min(d1), max(d2) - min(d2), max(d3) - min(d3)]) s from cal group by person, rec, mode having count(distinct judge) > 1) group by all),
 vn as (select person, mode, list_sort(list(distinct venue)) v from g where run = 0 group by all), l as (select person, mode, count(*) n, round(avg(d1), 6) d1, round(stddev_pop(d1), 6) sd, round(avg(coverage), 6) coverage, max(judges) judges from con group by all)
 select r.person, md.mode, coalesce(n, 0) n, d1, sd, coverage, array_to_string(v, ',') venues, judges, round(spread, 6) spread, case when n is null then 'no_grades' when judges < 2 or n < 3 then 'low' when n < 5 then 'medium' else 'high' end confidence
 from r cross join md left join l on l.person = r.person and l.mode = md.mode left join sp on sp.person = r.person and sp.mode = md.mode left join vn on vn.person = r.person and vn.mode = md.mode"""
)
def person_rollup(spark, d):
    """Each roster person and mode: means, spread of the judges over recordings and dimensions, venues and confidence."""
    g = first_ratings(spark, d)
    cal = rt.calibrated(g)
    n = rt.consensus(cal).groupBy("person", "mode").agg(F.count("*").alias("n"), r6(F.avg("d1")).alias("d1"), r6(F.stddev_pop("d1")).alias("sd"), r6(F.avg("coverage")).alias("coverage"), F.max("judges").alias("judges"))
    ranges = cal.groupBy("person", "rec", "mode").agg(F.array(*[F.max(x) - F.min(x) for x in rt.DIMENSIONS]).alias("s"), F.count_distinct("judge").alias("k")).where("k > 1")
    spread = ranges.select("person", "mode", F.explode("s").alias("s")).groupBy("person", "mode").agg(r6(F.avg("s")).alias("spread"))
    venues = g.where("run = 0").groupBy("person", "mode").agg(F.array_join(F.array_sort(F.collect_set("venue")), ",").alias("venues"))
    roster = read(spark, d, "part").select(F.col("p_brand").alias("person")).distinct().select("person", F.explode(F.array(F.lit("F"), F.lit("O"))).alias("mode"))
    out = roster.join(n, ["person", "mode"], "left").join(spread, ["person", "mode"], "left").join(venues, ["person", "mode"], "left")
    confidence = F.when(F.col("n").isNull(), "no_grades").when((F.col("judges") < 2) | (F.col("n") < 3), "low").when(F.col("n") < 5, "medium").otherwise("high")
    return out.withColumn("confidence", confidence).select("person", "mode", F.coalesce("n", F.lit(0)).alias("n"), "d1", "sd", "coverage", "venues", "judges", "spread", "confidence")


@query(
    f"""with {G}, h as (select judge, case when rec % 7 = 0 then null when rec % 2 = 0 then 'lab' else 'field' end harness from g) select judge, count(*) filter (harness = 'lab') lab, count(*) filter (harness = 'field') field, count(*) filter (harness is null) production from h group by judge"""
)
def harness_counts(spark, d):
    """Ratings of each judge by harness; without one they are production's."""
    harness = F.when(F.col("rec") % 7 == 0, None).when(F.col("rec") % 2 == 0, "lab").otherwise("field")
    g = ratings(spark, d).select("judge", F.coalesce(harness, F.lit("production")).alias("harness"))
    return g.groupBy("judge").pivot("harness", ["lab", "field", "production"]).count().fillna(0)


@query(
    f"""with {G}, m as (select rec, avg(d1) filter (judge = 'N') s, avg(d1) filter (judge <> 'N') p from g where run = 0 and mode = 'F' group by rec), q as (select person, s - p x from m join (select distinct rec, person from g) k on k.rec = m.rec where s is not null and p is not null)
 select person, count(*) n, case when count(*) >= 3 then round(avg(x), 6) end mean_gap, case when count(*) >= 3 then round(avg(abs(x)), 6) end mean_abs, case when count(*) >= 3 then round(median(x), 6) end median_gap from q group by person"""
)
def shadow_pairs(spark, d):
    """A shadow judge against the mean of the published ones, per person with at least three recordings."""
    m = ratings(spark, d).where("run = 0 and mode = 'F'").groupBy("person", "rec").agg(F.avg(F.when(F.col("judge") == "N", F.col("d1"))).alias("s"), F.avg(F.when(F.col("judge") != "N", F.col("d1"))).alias("p"))
    q = m.where("s is not null and p is not null").withColumn("x", F.col("s") - F.col("p")).groupBy("person")
    enough = lambda c: r6(F.when(F.count("*") >= 3, c))
    return q.agg(F.count("*").alias("n"), enough(F.avg("x")).alias("mean_gap"), enough(F.avg(F.abs("x"))).alias("mean_abs"), enough(F.median("x")).alias("median_gap"))


@query(
    f"""with {G}, m as (select person, judge, mode, count(*) n, count(*) filter (d1 > 25) confident, count(*) filter (d1 > 25 and d2 > 30) correct from g where run = 0 group by all)
 select person, judge, mode, n, round(confident / n, 6) confident, round(correct / n, 6) correct, mode = 'O' and correct / n >= 0.2 disclosed from m"""
)
def identity_rates(spark, d):
    """How often a judge was sure of the speaker, and right, by person and mode; the rate at which disclosure holds."""
    sure, right = (F.col("d1") > 25).cast("double"), ((F.col("d1") > 25) & (F.col("d2") > 30)).cast("double")
    m = ratings(spark, d).where("run = 0").groupBy("person", "judge", "mode").agg(F.count("*").alias("n"), F.avg(sure).alias("c"), F.avg(right).alias("r"))
    return m.select("person", "judge", "mode", "n", r6(F.col("c")).alias("confident"), r6(F.col("r")).alias("correct"), ((F.col("mode") == "O") & (F.col("r") >= 0.2)).alias("disclosed"))


@query(
    f"""with {G}, i as (select stddev_samp(d1) sd from g where run = 0), p as (select person, substr(person, 7)::int % 2 lean, count(distinct rec) m from g group by person), s as (select count(*) filter (lean = 0) l, count(*) filter (lean = 1) r from p)
 select person, lean, m, round(1.645 * sqrt(sd * sd * (0.3 + 0.7 / m) * (1.0 / l + 1.0 / r)), 6) half_width from p, s, i"""
)
def lean_half_widths(spark, d):
    """The half width that an interval of a lean difference would have with each person's number of recordings, at an ICC of 0.3."""
    g = ratings(spark, d)
    p = g.groupBy("person").agg(F.count_distinct("rec").alias("m")).withColumn("lean", F.substring("person", 7, 9).cast("int") % 2)
    s = p.agg(F.count_if(F.col("lean") == 0).alias("l"), F.count_if(F.col("lean") == 1).alias("r")).crossJoin(g.where("run = 0").agg(F.stddev_samp("d1").alias("sd")))
    return p.crossJoin(F.broadcast(s)).select("person", "lean", "m", r6(iv.half_width(F.col("sd"), F.lit(0.3), F.col("l"), F.col("r"), F.col("m"))).alias("half_width"))  # one row


@query(
    f"""with recursive {G}, a as (select person, count(*) filter (run = 0) n, count(*) filter (run = 0 and d1 > 40) k from g group by person),
 b as (select person, n, k, 0 i, 0.0::double ll, 1.0::double lh, 0.0::double hl, 1.0::double hh from a
 union all select person, n, k, i + 1, case when tl < 0.025 then (ll + lh) / 2 else ll end, case when tl < 0.025 then lh else (ll + lh) / 2 end, case when th < 0.975 then (hl + hh) / 2 else hl end, case when th < 0.975 then hh else (hl + hh) / 2 end
 from (select *, list_sum([exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln((ll + lh) / 2) + (n - j) * ln(1 - (ll + lh) / 2)) for j in range(k, n + 1)]) tl,
 coalesce(list_sum([exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln((hl + hh) / 2) + (n - j) * ln(1 - (hl + hh) / 2)) for j in range(k + 1, n + 1)]), 0.0) th from b) where i < 50)
 select person, n, k hits, round(case when k = 0 then 0.0 else (ll + lh) / 2 end, 6) lo, round(case when k = n then 1.0 else (hl + hh) / 2 end, 6) hi from b where i = 50"""
)
def exact_rates(spark, d):
    """Exact bounds of each person's share of high ratings."""
    a = ratings(spark, d).where("run = 0").groupBy("person").agg(F.count("*").alias("n"), F.count_if(F.col("d1") > 40).alias("hits"))
    return a.select("*", F.explode(F.array(sp.clopper_pearson(F.col("hits"), F.col("n")))).alias("ci")).select("person", "n", "hits", r6(F.col("ci.lo")).alias("lo"), r6(F.col("ci.hi")).alias("hi"))


ORACLES["board_bootstrap"] = f"with {_ratio_sql('select user_id grp, event_id unit, value num, 1.0::double den from events', 100, 0.1)} select grp person, units n, round(lo, 6) lo, round(hi, 6) hi from ci2"
