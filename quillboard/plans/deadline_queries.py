"""Queries of due dates: what the claims of the orders table name, derive or imply."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from quillboard.operators import deadlines as dl
from quillboard.operators.rater import r6
from quillboard.plans.registry import query
from quillboard.sources.tables import CATEGORIES, CLAIMS, FORMS, PHRASES, claims, read


def _list(of: list) -> str:
    return "[" + ", ".join("null" if x is None else "'" + x.replace("'", "''") + "'" for x in of) + "]"


def _cut():
    return F.lit("1996-12-31").cast("date")

C = f"""c0 as (select o_orderkey id, o_custkey person, o_orderdate::date said, o_custkey % 15 + 1 n, o_orderkey k, o_custkey c, o_orderpriority[1] f, o_orderstatus st, (o_orderdate::date + to_months((o_custkey % 30)::int))::date t from orders),
 c as (select id, person, said, case when k % 4 = 0 then said - (c % 40)::int end earliest, replace(replace({_list(PHRASES)}[k % {len(PHRASES)} + 1], '{{n}}', n::varchar), '{{m}}', (n + c % 7)::varchar) phrase,
 case when k % 3 = 0 then case f when '1' then strftime(t, '%Y') when '2' then strftime(t, '%Y-%m') when '3' then strftime(t, '%Y-%m-%d') else 'by then' end end target,
 case when k % 11 = 0 then n * 0.5::double end as years, case when k % 9 = 0 then 'we expect that shortly' else 'we expect that' end quote,
 {_list(CLAIMS)}[(k + c) % {len(CLAIMS)} + 1] claim, case when k % 13 = 0 then 'holds over decades' else 'holds' end criteria, {_list(FORMS)}[c % {len(FORMS)} + 1] form, {_list(CATEGORIES)}[c % {len(CATEGORIES)} + 1] category,
 case st when 'F' then 'own' when 'O' then 'other' end control, case c % 4 when 0 then 'high' when 1 then 'medium' when 2 then 'low' end specificity from c0)"""
#: each rule of the span in a column of its own, the first that applies wins
SPAN = r"""w(w, v) as (values ('a', 1), ('an', 1), ('one', 1), ('two', 2), ('couple', 2), ('three', 3), ('few', 3), ('several', 3), ('four', 4), ('five', 5), ('six', 6), ('seven', 7), ('eight', 8), ('nine', 9), ('ten', 10), ('twelve', 12), ('fifteen', 15), ('twenty', 20)),
 h0 as (select *, regexp_extract(phrase, '([0-9]+) to ([0-9]+) (year|month|week|day)', ['a', 'b', 'u']) rg, regexp_extract(phrase, '([0-9]+) (year|month|week|day)', ['a', 'u']) nu,
 regexp_extract(phrase, '\b(a|an|one|two|couple|three|few|several|four|five|six|seven|eight|nine|ten|twelve|fifteen|twenty) (?:more )?(year|month|week|day)s?\b', ['w', 'u']) wo from c),
 h as (select h0.* exclude (rg, nu, wo),
 case when phrase is null then 'no_horizon_text' when phrase like '%every%' then 'recurring' when regexp_matches(phrase, 'or more|at least|lifetime|someday') then 'open_ended' when rg.a <> '' then 'range upper bound' when nu.a <> '' then 'number and unit'
 when wo.w <> '' then 'word count and unit' when phrase like '%first half of next year%' then 'first half of next year' when phrase like '%the next year%' then 'the next year, twelve months' when phrase like '%next year%' then 'next year'
 when not regexp_matches(phrase, '\b(year|month|week|day)s?\b|[0-9]') then 'event_anchored' else 'no_horizon_value' end how,
 case how when 'range upper bound' then greatest(try_cast(rg.a as int), try_cast(rg.b as int)) when 'number and unit' then try_cast(nu.a as int) when 'word count and unit' then w.v when 'first half of next year' then 1 when 'the next year, twelve months' then 1 when 'next year' then 1 end::double as count,
 case how when 'range upper bound' then rg.u when 'number and unit' then nu.u when 'word count and unit' then wo.u when 'first half of next year' then 'year' when 'the next year, twelve months' then 'year' when 'next year' then 'year' end unit
 from h0 left join w on w.w = wo.w)"""
MACRO_DAYS = "case {u} when 'year' then 365.25 when 'month' then 30.44 when 'week' then 7.0 else 1.0 end"


def _add(start: str, count: str, unit: str) -> str:
    return f"""case when {unit} = 'year' and {count} = floor({count}) then ({start} + to_years({count}::int))::date when {unit} = 'month' and {count} = floor({count}) then ({start} + to_months({count}::int))::date
 else {start} + round_even({count} * {MACRO_DAYS.format(u=unit)}, 0)::int end"""


DER = f"""{SPAN}, d as (select *, coalesce(regexp_matches(phrase, 'this year|next year') and year(earliest) <> year(said), false) crosses,
 case when coalesce(regexp_matches(phrase, 'this year|next year') and year(earliest) <> year(said), false) then 'range_crosses_new_year' when years is not null then 'horizon_years_inferred' when phrase like '%this year%' then 'the calendar year of the statement'
 when how = 'next year' then 'the calendar year after the statement' when how = 'first half of next year' then 'the first half of the calendar year after the statement' else how end dhow,
 case dhow when 'range_crosses_new_year' then null when 'horizon_years_inferred' then {_add('said', 'years', "'year'")} when 'the calendar year of the statement' then make_date(year(said), 12, 31)
 when 'the calendar year after the statement' then make_date(year(said) + 1, 12, 31) when 'the first half of the calendar year after the statement' then make_date(year(said) + 1, 6, 30) else {_add('said', 'count', 'unit')} end derived from h)"""
TREND = r"""tr as (select *, (date '1996-12-31' - said) / 365.25 el, printf('%.1f', (date '1996-12-31' - said) / 365.25) shown, case when (date '1996-12-31' - said) / 365.25 < 3 then 'only ' || printf('%.1f', (date '1996-12-31' - said) / 365.25) || 'y elapsed, under 3.0y'
 when not regexp_matches(claim || ' ' || criteria || ' ' || quote, '\b(grow|stay|higher)\b') then 'no direction to test' else 'trend over ' || printf('%.1f', (date '1996-12-31' - said) / 365.25) || 'y since the statement' end thow from d)"""


def _implied(scale: float) -> str:
    def words(row: str, count: float, unit: str, where: str | None) -> str:
        c = count * scale
        return "'implied: " + row.replace("'", "''") + (f" ({where})" if where else "") + f", {c:g} {unit}{'' if c == 1 else 's'}" + ("" if scale == 1 else f" at {scale:g}x") + "'"

    rows = [("pw", 3, "month", "words: coming weeks", "phrase"), ("pm", 12, "month", "words: coming months", "phrase"), ("ps", 1, "year", "words: soon", "phrase"), ("pe", 5, "year", "words: eventually", "phrase"), ("qs", 1, "year", "words: soon", "quote")]
    rows += [("k1", 1, "year", "claim: the speaker's own company or product", None), ("k2", 3, "year", "claim: another company", None), ("k3", 3, "year", "claim: policy or regulation", None), ("k4", 5, "year", "claim: everything else", None)]
    basis = " ".join(f"when '{k}' then {words(row, n, u, where)}" for k, n, u, row, where in rows)
    dates = " ".join(f"when '{k}' then {_add('said', f'{n * scale}', chr(39) + u + chr(39))}" for k, n, u, row, where in rows)
    names = " ".join("when '{}' then '{}'".format(k, row.replace("'", "''")) for k, _, _, row, _ in rows)
    return f"""im as (select *, case when criteria like '%decades%' or phrase like '%lifetime%' or coalesce(try_cast(regexp_extract(phrase, 'at least ([0-9]+) year', 1) as int), 0) > 5 then 'speaker_horizon_longer'
 when form in ('conditional', 'ordering', 'recurring') then form || '_claim' when form is null and regexp_matches(claim, '\\bif\\b') then 'conditional_claim' when form is null and claim like '%before the rival%' then 'ordering_claim' when form is null and claim like '%annually%' then 'recurring_claim'
 when phrase like '%coming months, soon%' then 'implied_ambiguous_words' when phrase like '%coming weeks%' then 'pw' when phrase like '%coming months%' then 'pm' when phrase like '%soon%' then 'ps' when phrase like '%someday%' then 'pe' when quote like '%shortly%' then 'qs'
 when category in ('company_business', 'technology_product') and control = 'own' then 'k1' when category in ('company_business', 'technology_product') then 'k2' when category = 'policy_regulation' then 'k3' else 'k4' end code,
 coalesce(case code {basis} end, code) ibasis, case code {dates} end implied, case code {names} end irow, case code when 'pw' then 14 when 'pm' then 61 end shortest, coalesce(regexp_matches(phrase, 'coming|soon|someday') and not regexp_matches(phrase, '[0-9]'), false) vague from d)"""


STATED = "case when length(target) = 4 then make_date(target::int, 12, 31) when length(target) = 7 and target[1] <> 'b' then last_day((target || '-01')::date) when length(target) = 10 then target::date end"
ATTACHED = f"""{_implied(1)}, ats as (select *, {STATED} stated, case when target is null then 'missing' when target = 'by then' then 'malformed' else 'ok' end note from im),
 a as (select id, person, said, specificity, case when note = 'ok' then stated when note = 'malformed' or crosses then null when not vague and derived is not null then derived when implied is null then null when not vague and dhow in ('recurring', 'event_anchored') then null else implied end deadline,
 case when note = 'ok' then 'stated' when note = 'malformed' or crosses then null when not vague and derived is not null then 'derived: ' || dhow when implied is null then null when not vague and dhow in ('recurring', 'event_anchored') then null else ibasis end basis,
 case when note = 'ok' then null when note = 'malformed' then note when crosses then 'range_crosses_new_year' when not vague and derived is not null then null when implied is null then ibasis when not vague and dhow in ('recurring', 'event_anchored') then dhow end why_none,
 case when basis like 'implied%' then irow end as row, case when basis like 'implied%' then shortest end shortest from ats)"""
FLAGS = """fl as (select *, deadline - said lead, coalesce(deadline < said, false) as before, coalesce(specificity in ('high', 'medium'), false) spec_ok, coalesce(basis like 'trend%', false) trend,
 case when basis like 'implied%' then coalesce(shortest >= 60, false) else coalesce(deadline - said >= 60, false) end lead_ok, trend or (spec_ok and lead_ok and not before) eligible,
 list_filter([case when before then 'deadline_before_statement' end, case when not spec_ok then 'specificity' end, case when lead is null then 'undated' end, case when lead is not null and not lead_ok then 'lead_under_floor' end], lambda x: x is not null) failing,
 case when not eligible then failing[1] end reason from {0})"""
TATTACHED = f"""{TREND}, a as (select id, person, said, specificity, null::int shortest, case when target = 'by then' then null when target is not null then {STATED} when derived is not null then derived when thow like 'trend%' then date '1996-12-31' end deadline,
 case when target = 'by then' then null when target is not null then 'stated' when derived is not null then 'derived: ' || dhow when thow like 'trend%' then 'trend: ' || thow end basis from tr)"""


@query(f"with {C}, {SPAN} select id, count, unit, how from h")
def horizon_spans(spark, d):
    return claims(spark, d).select("id", dl.horizon_span(F.col("phrase")).alias("s")).select("id", "s.count", "s.unit", "s.how")


@query(f"with {C}, {DER} select id, derived deadline, dhow how from d")
def derived_deadlines(spark, d):
    return dl.with_derived(claims(spark, d)).select("id", "derived.deadline", "derived.how")


@query(f"with {C}, {DER}, {TREND} select id, case when thow like 'trend%' then date '1996-12-31' end deadline, thow how from tr")
def trend_windows(spark, d):
    at = dl.trend_deadline(F.col("said"), [F.col("claim"), F.col("criteria"), F.col("quote")], _cut())
    return claims(spark, d).select("id", at.alias("a")).select("id", "a.deadline", "a.how")


@query(f"with {C}, {DER}, {_implied(0.5)} select id, implied deadline, ibasis basis, irow as row, shortest, coalesce(shortest >= 60, false) lead_ok from im")
def implied_windows(spark, d):
    """At half the windows; whether the shortest reading of the words reaches the lead floor."""
    c = claims(spark, d)
    w = dl.implied_window(c["said"], {n: c[n] for n in ("phrase", "quote", "claim", "criteria")}, c["form"], c["category"], c["control"], 0.5)
    return c.select("id", w.alias("w")).select("id", "w.deadline", "w.basis", "w.row", "w.shortest", F.coalesce(F.col("w.shortest") >= dl.LEAST_LEAD, F.lit(False)).alias("lead_ok"))


@query(f"with {C}, {DER}, {ATTACHED} select id, deadline, basis, why_none, row, shortest from a")
def attached_deadlines(spark, d):
    return dl.attach_deadlines(claims(spark, d), implied_scale=1.0).select("id", "deadline", "basis", "why_none", "row", "shortest")


@query(f"with {C}, {DER}, {ATTACHED} select coalesce(basis, 'none: ' || why_none) outcome, count(*) n, count(distinct person) people, min(deadline) earliest, max(deadline) latest from a group by 1")
def deadline_counts(spark, d):
    """How many claims each rule dates, and why the others have no date."""
    a = dl.attach_deadlines(claims(spark, d), implied_scale=1.0)
    return a.groupBy(F.coalesce("basis", F.concat(F.lit("none: "), "why_none")).alias("outcome")).agg(F.count("*").alias("n"), F.count_distinct("person").alias("people"), F.min("deadline").alias("earliest"), F.max("deadline").alias("latest"))


@query(f"with {C}, {DER}, {ATTACHED}, {FLAGS.format('a')} select id, lead, before, spec_ok, lead_ok, trend, eligible, array_to_string(failing, ',') failing, reason from fl")
def failing_clauses(spark, d):
    f = dl.funnel_flags(dl.attach_deadlines(claims(spark, d), implied_scale=1.0))
    return f.select("id", "lead", "before", "spec_ok", "lead_ok", "trend", "eligible", F.array_join("failing", ",").alias("failing"), "reason")


LABELLED = "lb as (select doc_id id, case when quality = 1 then 'world_forecast' else 'announcement' end as label from labels)"


@query(
    f"""with {C}, {DER}, {TATTACHED}, r as (select l_orderkey id, l_shipdate::date judged from lineitem where l_linenumber = 1 qualify row_number() over (partition by l_orderkey order by l_shipdate) = 1),
 b as (select a.* exclude (deadline), case when basis like 'trend%' and judged is not null then judged else deadline end deadline, basis like 'trend%' and judged is not null frozen from a left join r on r.id = a.id), {FLAGS.format('b')}, {LABELLED},
 g as (select fl.*, fl.lead_ok or coalesce(label = 'world_forecast' and lead is not null and not trend and spec_ok and not before, false) ok2 from fl left join lb on lb.id = fl.id)
 select person, count(*) n, count(*) filter (frozen) frozen, count(*) filter (trend or (spec_ok and ok2 and not before)) eligible, min(deadline) first_due from g where deadline <= date '1996-12-31' group by person"""
)
def due_claims(spark, d):
    """Per person: claims that are due, those whose window a resolution froze, and those that are eligible."""
    lines = read(spark, d, "lineitem").where("l_linenumber = 1").groupBy(F.col("l_orderkey").alias("id")).agg(F.min(F.to_date("l_shipdate")).alias("judged"))
    labels = read(spark, d, "labels").select(F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, "world_forecast").otherwise("announcement").alias("label"))
    due = dl.due_set(dl.attach_deadlines(claims(spark, d), trend_cutoff=_cut()), lines, _cut())
    return dl.funnel_flags(due, labels=labels).groupBy("person").agg(F.count("*").alias("n"), F.count_if("frozen").alias("frozen"), F.count_if("eligible").alias("eligible"), F.min("deadline").alias("first_due"))


def _scaled(scale: float) -> str:
    return f"""(with {C}, {DER}, {_implied(scale)}, ats as (select *, {STATED} stated from im) select person, {scale}::double scale, count(*) claims, avg((case when target is not null then stated when not vague and derived is not null then derived when not vague and dhow in ('recurring', 'event_anchored') then null else implied end) - said) mean_window,
 count(*) filter ((case when target is not null then stated when crosses then null when not vague and derived is not null then derived when not vague and dhow in ('recurring', 'event_anchored') then null else implied end) <= date '1996-12-31') due from ats where not (crosses and target is null) group by person)"""


@query(
    f"""with s as (select * from {_scaled(0.5)} union all select * from {_scaled(1.0)} union all select * from {_scaled(2.0)})
 select person, scale, due, round(mean_window, 6) mean_window, row_number() over (partition by scale order by due desc, person) as rank from s"""
)
def implied_sensitivity(spark, d):
    """Persons by claims due with implied windows at half, whole and double length."""
    parts = []
    for scale in (0.5, 1.0, 2.0):
        a = dl.attach_deadlines(claims(spark, d), implied_scale=scale).where("why_none is null or why_none <> 'range_crosses_new_year'")
        parts.append(a.withColumn("scale", F.lit(scale)))
    per = parts[0].union(parts[1]).union(parts[2]).groupBy("person", "scale").agg(F.count_if(F.col("deadline") <= _cut()).alias("due"), r6(F.avg(F.datediff("deadline", "said"))).alias("mean_window"))
    return per.withColumn("rank", F.row_number().over(Window.partitionBy("scale").orderBy(F.desc("due"), "person")))
