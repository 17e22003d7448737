"""The registered queries as SQL for another engine, written on their own."""

from __future__ import annotations

G = """g as (select p_brand person, l_partkey rec, l_returnflag judge, l_linestatus mode,
 row_number() over (partition by l_partkey, l_returnflag, l_linestatus order by l_orderkey, l_linenumber, l_extendedprice, l_shipdate) - 1 run,
 l_quantity d1, l_discount * 1000 d2, l_tax * 1000 d3, l_discount * 10 coverage, l_quantity share, 'v' || (l_suppkey % 5)::varchar venue, l_shipdate::date as day
 from lineitem join part on l_partkey = p_partkey)"""
LONG = """lg as (select judge, mode, 'd1' dim, d1 raw from g where run = 0 union all select judge, mode, 'd2', d2 from g where run = 0 union all select judge, mode, 'd3', d3 from g where run = 0),
 own as (select judge, mode, dim, round(avg(raw), 2) jm, round(stddev_pop(raw), 2) js, count(raw) n from lg group by all),
 pool as (select mode, dim, round(avg(raw), 2) pm, round(stddev_pop(raw), 2) ps from lg group by all),
 par as (select judge, own.mode, own.dim, jm, js, pm, ps, n, js >= 3 and n >= 25 rescaled from own join pool on own.mode = pool.mode and own.dim = pool.dim)"""


def _scaled(d: str) -> str:
    return f"case when {d}p.rescaled then least(100.0, greatest(1.0, {d}p.pm + (g.{d} - {d}p.jm) * {d}p.ps / {d}p.js)) else g.{d} end {d}"


CAL = "cal as (select g.person, g.rec, g.judge, g.mode, g.coverage, " + ", ".join(map(_scaled, ("d1", "d2", "d3"))) + " from g " + " ".join(f"join par {d}p on {d}p.judge = g.judge and {d}p.mode = g.mode and {d}p.dim = '{d}'" for d in ("d1", "d2", "d3")) + " where run = 0)"
CON = "con as (select person, rec, mode, avg(d1) d1, avg(coverage) coverage, count(distinct judge) judges, max(d1) - min(d1) spread, avg(d1) * 0.4 + avg(d2) * 0.35 + avg(d3) * 0.25 overall from cal group by all)"
BOARD = f"with {G}, {LONG}, {CAL}, {CON}"
F = """f as (select event_id id, user_id person, ts, ts::date said, cast(json_extract_string(props, '$.k') as int) horizon,
 ts::date + cast(json_extract_string(props, '$.k') as int) deadline, least(0.99, greatest(0.01, value / 500)) p, event_type kind, value from events)"""
FLAGS = f"""{F}, fl as (select *, deadline - said lead, case when deadline < said then 'deadline_before_statement' when kind = 'error' then 'specificity' when deadline is null then 'undated' when deadline - said < 60 then 'lead_under_floor' else 'eligible' end reason,
 coalesce(deadline >= said and kind <> 'error' and deadline - said >= 60, false) eligible from f)"""
S = f"""{F}, s0 as (select *, kind = 'purchase' occurred, least(0.99, p + 0.1) q from f where kind <> 'error'),
 s as (select *, case when occurred then log2(q / p) else log2((1 - q) / (1 - p)) end points from s0)"""
TOK = "t as (select doc_id, regexp_extract_all(lower(text), '[a-z'']+') w from documents)"
NORM = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'))"

ORACLES = {
    "board_calibrated": f"""{BOARD}, b as (select person, count(*) n, round(sum(overall * greatest(coverage, 0.05)) / sum(greatest(coverage, 0.05)), 6) overall from con where mode = 'F' group by person)
 select person, n, overall, case when n >= 5 then row_number() over (partition by n >= 5 order by overall desc, person) end rank from b""",
    "calibration_params": f"with {G}, {LONG} select * from par",
    "share_filter": f"with {G} select rec, round(avg(share), 6) mean_share, min(share) min_share, not (avg(share) < 25 or min(share) = 0) kept from g group by rec",
    "complete_panels": f"with {G}, p as (select count(*) panel from (select distinct judge, mode from g)) select rec, count(distinct case when run = 0 then judge || mode end) cells, any_value(panel) panel, count(distinct case when run = 0 then judge || mode end) = any_value(panel) complete from g, p group by rec",
    "bucket_conservation": f"""with {G}, p as (select count(*) panel from (select distinct judge, mode from g)),
 m as (select rec, count(distinct case when run = 0 then judge || mode end) = any_value(panel) complete, not (avg(share) < 25 or min(share) = 0) kept from g, p group by rec),
 b as (select g.rec, case when run > 0 then 'repeat' when not complete then 'partial_panel' when not kept then 'unscorable' else 'usable' end bucket from g join m on g.rec = m.rec)
 select bucket, count(*) n, count(distinct rec) recordings from b group by bucket""",
    "consensus_spread": f"{BOARD} select person, rec, mode, round(d1, 6) d1, round(overall, 6) overall, round(coverage, 6) coverage, judges, case when judges > 1 then round(spread, 6) end spread from con",
    "venue_vote": f"""with {G}, v as (select rec, venue, count(*) votes from g where run = 0 group by all), r as (select *, row_number() over (partition by rec order by votes desc, venue) k, max(votes) over (partition by rec) top from v)
 select rec, max(case when k = 1 then venue end) venue, max(votes) votes, count(*) filter (votes = top) = 1 agreed from r group by rec""",
    "venue_support": f"with {G} select venue, count(*) n, count(distinct person) people, count(*) >= 8 and count(distinct person) >= 3 supported from g where run = 0 group by venue",
    "leave_one_venue_out": f"""with {G}, b as (select * from g where run = 0), v as (select distinct venue from b), p as (select distinct person, venue from b),
 m as (select p.venue, p.person, avg(case when b.venue <> p.venue then d1 end) mw, avg(d1) m from p join b on b.person = p.person group by all)
 select venue, person, round(mw, 6) mean_without, round(mw - m, 6) shift, row_number() over (partition by venue order by round(mw, 6) desc, person) rank from m""",
    "leader_rollup": f"""{BOARD}, l as (select person, mode, count(*) n, round(avg(d1), 6) d1, round(stddev_pop(d1), 6) sd, round(avg(coverage), 6) coverage, max(judges) judges from con group by all)
 select *, case when judges < 2 then 'low' when n >= 5 then 'high' when n >= 3 then 'medium' else 'low' end confidence from l""",
    "halo_pairs": f"with {G}, a as (select rec, judge, max(case when mode = 'O' then d1 end) o, max(case when mode = 'F' then d1 end) b from g where run = 0 group by all) select judge, count(*) n, round(avg(o - b), 6) halo, round(stddev_samp(o - b), 6) sd from a where o is not null and b is not null group by judge",
    "judge_pair_agreement": f"with {G}, m as (select rec, judge, avg(d1) v from g where run = 0 group by all) select a.judge judge_a, b.judge judge_b, count(*) n, round(corr(a.v, b.v), 6) r, round(avg(abs(a.v - b.v)), 6) gap from m a join m b on a.rec = b.rec and a.judge < b.judge group by all",
    "icc_ccc_loa": f"""with {G}, m as (select rec, judge, avg(d1) v from g where run = 0 group by all), p as (select a.judge judge_a, b.judge judge_b, a.v x, b.v y from m a join m b on a.rec = b.rec and a.judge < b.judge)
 select judge_a, judge_b, count(*) n, round(2 * covar_pop(x, y) / (var_pop(x) + var_pop(y) + pow(avg(x) - avg(y), 2)), 6) ccc, round(avg(x - y), 6) bias, round(avg(x - y) - 1.96 * stddev_samp(x - y), 6) loa_low, round(avg(x - y) + 1.96 * stddev_samp(x - y), 6) loa_high from p group by all""",
    "sample_icc": f"""with {G}, b as (select * from g where run = 0), c as (select person, count(*) k, avg(d1) m, sum(d1) s from b group by person), t as (select count(*) n, avg(d1) gm, stddev_samp(d1) sd from b),
 w as (select sum((b.d1 - c.m) * (b.d1 - c.m)) ssw from b join c on b.person = c.person), z as (select count(*) gr, sum(k * (m - gm) * (m - gm)) ssb, sum(k * k) kk, any_value(n) n, any_value(sd) sd from c, t)
 select gr::bigint as "groups", n::bigint n, round(sd, 6) sd, round(greatest(0.0, (ssb / (gr - 1) - ssw / (n - gr)) / (ssb / (gr - 1) + ((n - kk / n) / (gr - 1) - 1) * ssw / (n - gr))), 6) icc from z, w""",
    "repeatability": f"with {G} select judge, mode, count(*) n, round(avg(d1), 6) mean, round(stddev_samp(d1), 6) sd, min(d1) low, max(d1) high, round(100 * stddev_samp(d1) / avg(d1), 6) cv, round(2.77 * stddev_samp(d1), 6) lsd from g group by all",
    "retest": f"with {G} select a.judge, count(*) n, round(corr(a.d1, b.d1), 6) r, round(avg(b.d1 - a.d1), 6) drift, round(stddev_samp(b.d1 - a.d1), 6) sd from g a join g b on a.rec = b.rec and a.judge = b.judge and a.mode = b.mode and a.run = 0 and b.run = 1 group by a.judge",
    "ols_fit": """with g as (select l_returnflag judge, count(*) n, regr_slope(l_extendedprice / 1000, l_quantity) b, regr_intercept(l_extendedprice / 1000, l_quantity) a, regr_r2(l_extendedprice / 1000, l_quantity) r2, avg(l_quantity) mx from lineitem group by 1),
 s as (select judge, sum(pow(l_extendedprice / 1000 - a - b * l_quantity, 2)) sse, sum(pow(l_quantity - mx, 2)) sxx from lineitem join g on judge = l_returnflag group by 1), e as (select *, sqrt(sse / (n - 2) / sxx) se from g join s using (judge))
 select judge, n, round(b, 6) slope, round(a, 6) as "intercept", round(r2, 6) r2, round(se, 6) se, round(b / se, 6) t, round(b - 1.96 * se, 6) lo, round(b + 1.96 * se, 6) hi from e""",
    "era_slope": f"""with {G}, b as (select person, (day - date '1992-01-01') / 365.25 t, d1 from g where run = 0), c as (select person, t - avg(t) over (partition by person) x, d1 - avg(d1) over (partition by person) y from b)
 select count(*) n, round(sum(x * y) / sum(x * x), 6) slope from c""",
    "drift_gate": f"""with {G}, c as (select rec, judge, mode, arg_max(d1, run) - arg_min(d1, run) x from g group by all having max(run) > 0), m as (select judge, count(*) n, avg(x) m, stddev_samp(x) / sqrt(count(*)) se from c group by judge)
 select judge, n, round(m, 6) drift, round(m - 1.645 * se, 6) lo, round(m + 1.645 * se, 6) hi, case when m - 1.645 * se > -2 and m + 1.645 * se < 2 then 'PASS' when m - 1.645 * se >= 2 or m + 1.645 * se <= -2 then 'FAIL' else 'INCONCLUSIVE' end verdict from m""",
    "judge_lean": f"""with {G}, b as (select * from g where run = 0 and mode = 'F'), c as (select rec from b group by rec having count(*) = (select count(distinct judge) from b))
 select a.judge, count(distinct a.rec) n, round(avg(a.d1 - b.d1), 6) lean from b a join b on a.rec = b.rec and a.judge <> b.judge where a.rec in (select rec from c) group by a.judge""",
    "coverage_gate": f"with {G}, p as (select person, rec, count(*) filter (mode = 'F') blind, count(distinct judge) judges from g group by all) select person, count(*) recordings, count(*) filter (blind > 0) blinded, count(*) filter (judges = (select count(distinct judge) from g)) \"full\" from p group by person",
    "incidence_skew": f"with {G} select judge, mode, count(*) n, count(*) filter (share < 5) rejected, round(count(*) filter (share < 5) / count(*), 6) rate from g group by grouping sets ((judge, mode), (judge), ())",
    "eligibility": f"with {FLAGS} select reason, count(*) n, round(avg(lead), 6) mean_lead, count(*) filter (eligible) eligible from fl group by reason",
    "deadline_span": f"with {F} select id, said, horizon, case when horizon % 2 = 0 then (said + to_months(horizon))::date else said + cast(case when horizon * 1.5 % 1 = 0.5 then 2 * round(horizon * 1.5 / 2) else round(horizon * 1.5) end as int) end deadline from f",
    "log_score": f"with {S} select id, person, round(p, 6) p, round(q, 6) q, occurred, round(points, 6) points from s",
    "person_scores": f"""with {S}, a as (select person, count(*) n_scored, round(avg(points), 6) mean_points, round(sum(points), 6) sum_points, round(avg(occurred::int), 6) hit_rate, round(avg(p), 6) mean_p from s group by person)
 select *, case when n_scored >= 3 then row_number() over (partition by n_scored >= 3 order by mean_points desc, person) end rank from a""",
    "reliability": f"""with {S}, b(bin, lo, hi) as (values (0, 0.0, 0.2), (1, 0.2, 0.4), (2, 0.4, 0.6), (3, 0.6, 0.8), (4, 0.8, 1.0)),
 a as (select bin, lo, hi, count(p) n, round(avg(p), 6) mean_p, round(avg(occurred::int), 6) hit_rate, round(avg(points), 6) mean_points from b left join s on p >= lo and (p < hi or bin = 4) group by all)
 select bin::int bin, lo::double lo, hi::double hi, n, mean_p, hit_rate, round(hit_rate - mean_p, 6) gap, mean_points from a""",
    "separation": f"with {S} select count(*) n, round(avg(p) filter (occurred), 6) p_if_hit, round(avg(p * p) / avg(p), 6) expected, round(avg(p) filter (occurred) - avg(p * p) / avg(p), 6) excess from s",
    "unresolvable_split": f"with {FLAGS} select eligible, kind, count(*) n from fl where kind in ('error', 'signup') group by cube (eligible, kind)",
    "asof_market": f"""with {F}, a as (select f.id, f.person, arg_max(struct_pack(v := e.value, k := e.id), (epoch_us(e.ts), -e.id)) x from f left join f e on e.person = f.person and e.ts < f.ts group by all)
 select id, person, round(x.v, 6) prior_value, x.k prior_id from a""",
    "market_window": f"with {F} select person, case when said >= date '2024-02-15' then 'opens_late' when deadline < date '2024-02-15' then 'closed' else 'open' end state, count(*) n, min(deadline) first_deadline from f group by all",
    "year_cells": "select o_orderpriority, year(o_orderdate) as year, count(*) n, count(distinct o_custkey) people from orders group by all",
    "record_summary": "select c_mktsegment, count(*) n, count(*) filter (o_orderstatus = 'F') done, count(*) filter (o_orderstatus = 'O') open, round(sum(o_totalprice), 2) total from orders join customer on o_custkey = c_custkey group by rollup (c_mktsegment)",
    "breadth_first": "select doc_id, source, row_number() over (partition by source order by doc_id) depth from documents",
    "stratified_sample": "select source, lang, doc_id, k::int k from (select source, lang, doc_id, row_number() over (partition by source, lang order by sha256('salt:' || doc_id::varchar), doc_id) k from documents) where k <= 5",
    "qa_signals": f"with {TOK}, a as (select doc_id, len(w) words, round(list_unique(w) / nullif(len(w), 0), 6) ttr, len(list_filter(w, lambda x: length(x) >= 12)) long_words, round(len(list_filter(w, lambda x, i: i > 2 and w[i - 1] = x and w[i - 2] = x)) / nullif(len(w), 0), 6) loop_share from t) select *, case when words < 700 or loop_share > 0.02 then 'reject' else 'pass' end verdict from a",
    "mattr": f"with {TOK} select doc_id, round(case when len(w) <= 1000 then list_unique(w) / nullif(len(w), 0) else list_avg([list_unique(w[i + 1 : i + 1000]) / 1000 for i in range(0, len(w) - 999, 250)]) end, 6) mattr from t",
    "name_density": f"with {TOK}, s as (select d.doc_id, source, w, list_filter(w, lambda x: length(x) >= 4)[1] one from t join documents d on d.doc_id = t.doc_id), n as (select source, arg_min(one, doc_id) filter (one is not null) nm, arg_min(coalesce(one, ''), doc_id) name from s group by source), r as (select doc_id, name, len(w) n, w[floor(len(w) * 0.12)::int + 1 :] rest from s join n on n.source = s.source) select doc_id, case when n < 200 then 0.0 else round(1000.0 * len(list_filter(rest, lambda x: x = name)) / len(rest), 6) end density from r",
    "quote_ground": f"with q as (select item_id, string_split({NORM.format('text')}, ' ') q from benchmark where {NORM.format('text')} <> ''), n as (select doc_id, string_split({NORM.format('text')}, ' ') w from documents), e as (select doc_id, w, unnest(range(1, len(w) + 1)) at_ from n), h as (select e.doc_id, item_id from e join q on e.w[at_] = q[1] and e.w[at_ : at_ + len(q) - 1] = q) select item_id, count(distinct doc_id) documents, min(doc_id) first_doc, count(*) places from h group by item_id",
    "digest": f"select doc_id, substr(sha256(doc_id::varchar || chr(10) || {NORM.format('text')}), 1, 16) digest from documents",
    "speaker_ranges": "with c as (select conv_id, turn, role, len(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ')) n from conversations) select conv_id, turn, role, coalesce(sum(n) over (partition by conv_id order by turn, role, n rows between unbounded preceding and 1 preceding), 0)::bigint as start, n from c",
    "invariants": """with j as (select d.*, quality, toxic from documents d left join labels l on d.doc_id = l.doc_id),
 u as (select 'length' as invariant from j where n_chars <> length(text) union all select 'unlabelled' from j where quality is null union all select 'toxic' from j where toxic = 1 union all select 'language' from j where lang not in ('de', 'en', 'es', 'fr'))
 select invariant, count(*) n from u group by invariant""",
    "arrival_watermark": "select ts::date as day, event_type kind, count(*) n, round(sum(value), 4) total from events group by all",
    "window_freeze": f"with {F} select person, kind, arg_min(deadline, (epoch_us(ts), id)) deadline, count(*) n, count(distinct deadline) windows from f group by all",
    "search_rate_gate": f"""with {F}, a as (select kind judge, count(*) filter (person % 2 = 0) n_left, count(*) filter (person % 2 = 1) n_right, avg(x) filter (person % 2 = 0) l, avg(x) filter (person % 2 = 1) r, var_samp(x) filter (person % 2 = 0) vl, var_samp(x) filter (person % 2 = 1) vr
 from (select *, case when value > 100 then 100.0 else 0.0 end::double x from f) group by kind), b as (select *, l - r gap, sqrt(vl / n_left + vr / n_right) se from a)
 select judge, n_left, n_right, round(l, 6) rate_left, round(r, 6) rate_right, round(gap, 6) gap, round(se, 6) se, case when gap - 1.645 * se > -5 and gap + 1.645 * se < 5 then 'PASS' when gap - 1.645 * se >= 5 or gap + 1.645 * se <= -5 then 'FAIL' else 'INCONCLUSIVE' end verdict from b""",
    "deadline_stated": """with s as (select o_orderkey, o_orderdate::date d, o_orderpriority[1] k from orders)
 select o_orderkey, case k when '1' then strftime(d, '%Y') when '2' then strftime(d, '%Y-%m') when '3' then strftime(d, '%Y-%m-%d') when '4' then strftime(d, '%d.%m.%Y') end stated,
 case k when '1' then make_date(year(d), 12, 31) when '2' then last_day(d) when '3' then d end deadline, case k when '4' then 'malformed' when '5' then 'missing' else 'ok' end note from s""",
    "dates_in_text": """with o as (select o_orderkey, o_orderdate::date d from orders)
 select o_orderkey, k::int k, case k when 0 then strftime(d, '%B %-d, %Y') when 1 then strftime(d, '%B %Y') when 2 then strftime(d, '%Y-%m-%d') when 3 then strftime(d, '%Y-%m') when 4 then strftime(d, '%Y') else strftime(d, '%-d %B %Y') end as found,
 year(d)::int as year, case when k <> 4 then month(d)::int end as month, case when k in (0, 2, 5) then day(d)::int end as day from o, range(6) r(k)""",
    "outcome_join": f"""with {FLAGS}, j as (select fl.*, o.o_orderkey, o.o_orderstatus, o.o_orderdate, o.o_orderpriority, c.c_acctbal / 10000 prior,
 fl.id in (select doc_id from labels where toxic = 1) withdrawn, fl.id in (select p_partkey from part where p_size > 40) restated
 from fl left join orders o on o.o_orderkey = fl.id left join customer c on c.c_custkey = fl.id and c.c_acctbal > 0),
 s as (select *, case when withdrawn then 'withdrawn' when restated then 'restated' when not eligible then 'not_eligible:' || reason when o_orderdate::date < date '1993-06-01' then 'stale' when o_orderkey is null then 'no_resolution'
 when o_orderpriority = '1-URGENT' then 'already_public' when o_orderstatus not in ('F', 'O') then 'unresolvable' when prior is null then 'no_prior' else 'scored' end state from j)
 select state, count(*) n, count(distinct person) people, round(avg(case when state = 'scored' then prior end), 6) mean_prior from s group by state""",
    "schedule_blocks": "with r as (select doc_id, source, lang, row_number() over (partition by source, lang order by md5(doc_id::varchar), doc_id) as round from documents) select *, (round - 1) // 10 as block from r",
    "ngram_run": f"""with {TOK}, e as (select doc_id, len(w) n, unnest(w) x, generate_subscripts(w, 1) i from t), r as (select *, i - row_number() over (partition by doc_id, x order by i) g from e),
 m as (select doc_id, max(k) best from (select doc_id, count(*) k from r group by doc_id, x, g) group by doc_id) select t.doc_id, case when len(w) >= 10 and best > 5 then best - 4 else 0 end run from t left join m on m.doc_id = t.doc_id""",
    "stutter_collapse": """with a as (select doc_id, string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ') w from documents), e as (select doc_id, unnest(w) x, generate_subscripts(w, 1) i from a),
 k as (select *, lower(trim(x, '.,!?')) y from e), r as (select *, i - row_number() over (partition by doc_id, y order by i) g from k), p as (select *, row_number() over (partition by doc_id, y, g order by i) p from r)
 select doc_id, count(*) words, count(*) filter (p > 2 and y <> '') removed, count(*) filter (p = 3 and y <> '') runs, md5(string_agg(x, ' ' order by i) filter (p <= 2 or y = '')) kept_md5 from p group by doc_id""",
    "replay_share": f"""with {TOK}, g as (select doc_id, unnest(range(0, len(w) - 19)) p, unnest([array_to_string(w[q + 1 : q + 20], ' ') for q in range(0, len(w) - 19)]) h from t),
 r as (select doc_id, p, p > min(p) over (partition by doc_id, h) again from g), c as (select doc_id, count(distinct p + o) k from r, range(20) z(o) where again group by doc_id)
 select t.doc_id, len(w) words, coalesce(k, 0) replayed, round(coalesce(k, 0) / greatest(len(w), 1), 6) share, coalesce(k, 0) >= 0.05 * greatest(len(w), 1) flagged from t left join c on c.doc_id = t.doc_id""",
    "near_dup_pairs": """with t as (select doc_id, lang, regexp_extract_all(lower(text), '[a-z'']+') w from documents), s as (select lang, min(doc_id) doc_id, g from (select doc_id, lang, list_sort(list_distinct([array_to_string(w[i : i + 4], ' ') for i in range(1, len(w) - 3)])) g from t where len(w) >= 5) group by lang, g),
 e as (select lang, doc_id, len(g) n, unnest(g) h from s), c as (select a.doc_id doc_a, b.doc_id doc_b, least(any_value(a.n), any_value(b.n)) m, count(*) common from e a join e b on a.lang = b.lang and a.h = b.h and a.doc_id < b.doc_id group by all)
 select doc_a, doc_b, common, round(common / m, 6) containment from c where common >= 0.75 * m""",
    "sound_groups": """with w as (select distinct unnest(regexp_extract_all(lower(text), '[a-z'']+')) word from conversations), s as (select word, replace(replace(replace(replace(replace(replace(replace(word, '''', ''), 'ph', 'f'), 'ck', 'k'), 'x', 'ks'), 'q', 'k'), 'c', 'k'), 'z', 's') v from w),
 c as (select word, left(v, 1) || regexp_replace(substr(v, 2), '[aeiouy]', '', 'g') v from s), q as (select word, array_to_string([v[i] for i in range(1, length(v) + 1) if i = 1 or v[i] <> v[i - 1]], '') sound from c)
 select sound, count(*) words, min(word) as first, max(word) as last from q group by sound""",
}

ORACLES["qa_gate"] = r"""with b as (select doc_id, text, regexp_replace(regexp_replace(coalesce(text, ''), '\[\d{2}:\d{2}:\d{2}\]', ' ', 'g'), '(?i)\[(music|applause|laughter|cheering|silence)\]', ' ', 'g') bare from documents),
 t as (select doc_id, len(regexp_extract_all(coalesce(text, ''), '(?i)\[(music|applause|laughter|cheering|silence)\]')) nonspeech, regexp_extract_all(lower(bare), '[a-z'']+') w from b),
 e as (select doc_id, len(w) n, unnest(w) x, generate_subscripts(w, 1) i from t), r as (select *, i - row_number() over (partition by doc_id, x order by i) g from e), m as (select doc_id, max(k) best from (select doc_id, count(*) k from r group by doc_id, x, g) group by doc_id),
 s as (select t.doc_id, len(w) words, round(len(list_filter(w, lambda x, i: i > 2 and w[i - 1] = x and w[i - 2] = x)) / nullif(len(w), 0), 5) loop_share, case when len(w) >= 10 and best > 5 then best - 4 else 0 end loop_score, list_unique(w) kinds, case when len(w) <= 1000 then list_unique(w) else list_sum([list_unique(w[i + 1 : i + 1000]) for i in range(0, len(w) - 999, 250)]) end moved, case when len(w) <= 1000 then len(w) else 1000 * ((len(w) - 1000) // 250 + 1) end of_, nonspeech from t left join m on m.doc_id = t.doc_id),
 s2 as (select doc_id, words, loop_share, loop_score, (20000 * kinds + words) // nullif(2 * words, 0) / 10000 ttr, (20000 * moved + of_) // nullif(2 * of_, 0) / 10000 mattr, nonspeech from s),
 v as (select *, case when words = 0 then 'empty_after_cleaning' else array_to_string(list_filter([case when words < 700 then 'word_count' end, case when loop_share > 0.02 then 'loop_share' end, case when mattr < 0.28 then 'mattr' end], lambda x: x is not null), ',') end reasons from s2) select *, case when reasons = '' then 'pass' else 'reject' end verdict from v"""
ORACLES["span_dedupe"] = f"""with recursive q as (select item_id, string_split({NORM.format('text')}, ' ') q from benchmark where {NORM.format('text')} <> ''), n as (select doc_id, string_split({NORM.format('text')}, ' ') w from documents), e as (select doc_id, w, unnest(range(1, len(w) + 1)) at_ from n),
 h as (select e.doc_id, item_id, at_ s, at_ + len(q) e from e join q on e.w[at_] = q[1] and e.w[at_ : at_ + len(q) - 1] = q), o as (select *, row_number() over (partition by doc_id order by s - e, s, item_id) k, count(*) over (partition by doc_id) spans from h),
 st as (select doc_id, 1 k, spans, [{{'id': item_id, 's': s, 'e': e}}] kept from o where k = 1 union all select o.doc_id, o.k, o.spans, case when len(list_filter(st.kept, lambda y: greatest(0, least(o.e, y.e) - greatest(o.s, y.s)) >= 0.8 * greatest(o.e - o.s, y.e - y.s, 1))) > 0 then st.kept else list_append(st.kept, {{'id': o.item_id, 's': o.s, 'e': o.e}}) end
 from st join o on o.doc_id = st.doc_id and o.k = st.k + 1), f as (select doc_id, spans, unnest(kept) x from st where k = spans) select doc_id, spans, x.id item_id, x.s::int as start, x.e::int as "end" from f"""

#: Queries that SQL does not express: tests hold them against plain forms.
WITHOUT_SQL = {"venue_effects", "html_text"}
