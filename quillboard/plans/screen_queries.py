"""Queries of screens, validators and market matching."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from quillboard.functions import dates as dt, text as tx
from quillboard.operators import blinding as bl, likeness as lk, rater as rt, screens as sc, transcript as tr, vocabulary as vo
from quillboard.operators.rater import r6
from quillboard.plans.oracles import F as FC, G
from quillboard.plans.registry import query
from quillboard.sources.tables import forecasts, ratings, read

STOP = ["the", "of", "and", "to", "in", "a", "is", "for", "und", "der", "die", "de", "la", "le"]
STOPS = "(" + ", ".join(f"'{w}'" for w in STOP) + ")"


@query(
    r"""with t as (select doc_id, substr(text, 1, 120) title, source channel, n_chars from documents)
 select doc_id, case when regexp_matches(lower(title || ' ' || channel), '\bkeynote|gtc|wwdc|build \d|re:invent|i/o\b|summit|announce') then 'keynote' when regexp_matches(lower(title || ' ' || channel), '\bfireside|in conversation\b') then 'fireside' when regexp_matches(lower(title || ' ' || channel), '\bpanel\b') then 'panel'
 when regexp_matches(lower(title || ' ' || channel), '\bpodcast|show\b') then 'podcast' else 'interview' end kind,
 case when n_chars < 400 then 'too short (' || (n_chars // 60)::varchar || 'm)' when n_chars > 20000 then 'too long (' || (n_chars // 60)::varchar || 'm); excluded, not trimmed' when regexp_matches(title, '(?i)\b(license|clip|trailer)') then 'title indicates a clip, compilation, trailer or tribute' when doc_id % 2 = 0 and regexp_matches(channel, '[13579]$') then 'channel publishes clips or fan uploads' end rejected from t"""
)
def title_screen(spark, d):
    """The kind of each document as a recording, and why it is no candidate (its length standing for a duration)."""
    t = read(spark, d, "documents").select("doc_id", F.substring("text", 1, 120).alias("title"), F.col("source").alias("channel"), "n_chars")
    return t.select("doc_id", sc.kind_of(F.col("title"), F.col("channel")).alias("kind"), sc.title_rejection(F.col("n_chars"), F.col("title"), F.col("channel"), F.col("doc_id") % 2 == 0, 400, 20000, r"(?i)\b(license|clip|trailer)", r"[13579]$").alias("rejected"))


@query(
    rf"""with a as (select item_id, list_transform(regexp_extract_all(text, '[A-Za-z][A-Za-z0-9\-'']+|\d{{4}}|\d+(?:\.\d+)?%?'), lambda t: trim(lower(t), '''-')) t from benchmark), e as (select item_id, unnest(t) w, generate_subscripts(t, 1) i from a), f as (select item_id, w, min(i) i from e where length(w) >= 2 and w not in {STOPS} group by all),
 g as (select item_id, list(w order by i) toks, list(w order by i) filter (not regexp_matches(w, '^\d+(?:\.\d+)?%?$')) words, list(w order by -length(w), i) filter (not regexp_matches(w, '^\d+(?:\.\d+)?%?$')) rare from f group by item_id)
 select a.item_id, coalesce(len(toks), 0)::int tokens, array_to_string(list_slice(words, 1, 4), ' ') first_query, array_to_string(list_slice(rare, 1, 2), ' ') || ' 2024' rare_query from a left join g on g.item_id = a.item_id"""
)
def search_terms(spark, d):
    """Content words of each passage, and its searches by first and by rarest words."""
    b = read(spark, d, "benchmark")
    asked = sc.keyword_queries(F.col("text"), F.lit("2024"), STOP)
    return b.select("item_id", F.size(sc.content_tokens(F.col("text"), STOP)).alias("tokens"), F.get(asked, F.lit(0)).alias("first_query"), F.element_at(asked, -1).alias("rare_query"))


@query(
    r"""with c as (select conv_id, list(trim(regexp_replace(lower(substr(text, 1, 12)), '\s+', ' ', 'g'))) q, list(trim(regexp_replace(lower(substr(text, 1, 12)), '\s+', ' ', 'g'))) filter (turn % 2 = 0) ran from conversations group by conv_id),
 e as (select conv_id, len(list_distinct(list_filter(q, lambda x: x <> '')))::int searched, case when ran is not null then len(list_distinct(list_filter(ran, lambda x: x <> '')))::int end ran_n, len(list_filter(q, lambda x: x <> '' and not list_contains(ran, x))) > 0 never from c)
 select conv_id, searched, array_to_string(list_filter([case when ran_n is null then 'no_record' end, case when ran_n < 3 then 'too_few' end, case when never then 'never_ran' end], lambda x: x is not null), ',') errors from e"""
)
def effort_floor(spark, d):
    """The searches that each conversation names against those that were run, its even turns."""
    q = F.substring("text", 1, 12)
    c = read(spark, d, "conversations").groupBy("conv_id").agg(F.collect_list(q).alias("q"), F.collect_list(F.when(F.col("turn") % 2 == 0, q)).alias("ran"))
    ran = F.when(F.size("ran") > 0, F.col("ran"))
    return c.select("conv_id", sc.distinct_queries(F.col("q")).alias("searched"), F.array_join(sc.effort_errors(F.col("q"), ran), ",").alias("errors"))


@query(
    f"""with {FC}, r as (select f.id, case when id % 31 = 0 then id + 1 else id end rid, case when kind = 'error' then 'unresolvable' when kind = 'purchase' then 'occurred' else 'not_occurred' end outcome, case when id % 7 = 0 then 'ambiguous' end reason, horizon % 3 sources, id % 5 searched, case when id % 4 = 0 then said - (id % 3)::int end public, case when id % 12 <> 0 then said end bound from f)
 select id, array_to_string(list_filter([case when rid <> id then 'wrong_id' end, case when outcome = 'unresolvable' and reason is null then 'no_reason' end, case when outcome <> 'unresolvable' and reason is not null then 'reason_with_outcome' end, case when outcome <> 'unresolvable' and sources = 0 then 'no_source' end,
 case when searched < 3 then 'too_few_searches' end, case when public is not null and bound is null then 'public_without_statement_date' end, case when public >= bound then 'public_too_late' end], lambda x: x is not null), ',') errors from r"""
)
def resolution_errors(spark, d):
    """The rules that each resolution breaks."""
    f = forecasts(spark, d)
    i = F.col("id")
    some = lambda n: F.transform(F.sequence(F.lit(1), F.lit(9)), lambda k: F.when(k <= n, F.concat(F.lit("q"), k.cast("string"))))
    outcome = F.when(F.col("kind") == "error", "unresolvable").when(F.col("kind") == "purchase", "occurred").otherwise("not_occurred")
    errors = sc.resolution_errors(F.when(i % 31 == 0, i + 1).otherwise(i), i, outcome, F.when(i % 7 == 0, "ambiguous"), F.array_compact(some(F.col("horizon") % 3)), F.array_compact(some(i % 5)), F.when(i % 4 == 0, F.date_sub("said", (i % 3).cast("int"))), F.when(i % 12 != 0, F.col("said")))
    return f.select("id", F.array_join(errors, ",").alias("errors"))


@query(
    f"""with {FC}, r as (select id, case when id % 17 = 0 then 'soon' when id % 13 = 0 then '1.5' when id % 11 = 0 then '-0.1' else round(p, 4)::varchar end p, case when id % 29 = 0 then id - 1 else id end rid from f)
 select id, array_to_string(list_filter([case when rid <> id then 'wrong_id' end, case when try_cast(p as double) is null then 'not_a_number' end, case when try_cast(p as double) not between 0 and 1 then 'outside' end], lambda x: x is not null), ',') errors from r"""
)
def prior_errors(spark, d):
    i = F.col("id")
    p = F.when(i % 17 == 0, "soon").when(i % 13 == 0, "1.5").when(i % 11 == 0, "-0.1").otherwise(F.round("p", 4).cast("string"))
    return forecasts(spark, d).select("id", F.array_join(sc.prior_errors(F.when(i % 29 == 0, i - 1).otherwise(i), i, p), ",").alias("errors"))


@query(
    r"""with p as (select item_id, substr(text, 1, 30) q, 'What was said: ' || substr(text, 1, 30) || '. Tell whether it ' || ['turned out', 'did happen, in hindsight', 'may come', 'is an Outcome'][item_id % 4 + 1] || '.' prompt from benchmark),
 o as (select item_id, lower(case when length(q) > 0 then replace(prompt, q, ' ') else prompt end) t from p) select item_id, array_to_string(list_sort(list_distinct(regexp_extract_all(t, 'occurred|not_occurred|unresolvable|outcome|actually happened|in hindsight|turned out|as we now know|did happen|did not happen'))), ',') leaks from o"""
)
def prompt_leaks(spark, d):
    """Words of a prompt that would tell an outcome; what it quotes does not count."""
    q = F.substring("text", 1, 30)
    told = F.element_at(F.array(*map(F.lit, ["turned out", "did happen, in hindsight", "may come", "is an Outcome"])), (F.col("item_id") % 4 + 1).cast("int"))
    prompt = F.concat(F.lit("What was said: "), q, F.lit(". Tell whether it "), told, F.lit("."))
    return read(spark, d, "benchmark").select("item_id", F.array_join(sc.leaks(prompt, [q]), ",").alias("leaks"))


CODES = [f"c{k}" for k in range(15)]
GR = r"""gr as (select l_orderkey k, l_linenumber ln, l_quantity::int s1, (l_discount * 1000)::int s2, case when l_suppkey % 11 = 0 then null else (l_tax * 1000)::int + 1 end s3, l_partkey p, l_suppkey s, l_extendedprice e,
 list_transform(range(0, 15 - case when l_partkey % 19 = 0 then 1 else 0 end), lambda i: case when l_partkey % 23 = 0 and i = 3 then 'c2' else 'c' || i::varchar end) codes, list_transform(range(0, 15), lambda i: ((l_partkey + i) % case when l_partkey % 17 = 0 then 7 else 6 end)::int) scores,
 l_partkey % 30 + 1 rw, l_suppkey % 9 + 20 qw from lineitem)"""


def _grades(spark, d):
    """Grades as nested rows, some of them wrong in one way or another."""
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    words = lambda n: F.array_join(F.array_repeat(F.lit("word"), n.cast("int")), " ")
    codes = F.transform(F.sequence(F.lit(0), 14 - F.when(p % 19 == 0, 1).otherwise(0)), lambda i: F.when((p % 23 == 0) & (i == 3), "c2").otherwise(F.concat(F.lit("c"), i.cast("string"))))
    scores = F.transform(F.sequence(F.lit(0), F.lit(14)), lambda i: ((p + i) % F.when(p % 17 == 0, 7).otherwise(6)).cast("int"))
    s1, s2, s3 = F.col("l_quantity").cast("int"), F.round(F.col("l_discount") * 1000).cast("int"), F.when(s % 11 != 0, F.round(F.col("l_tax") * 1000).cast("int") + 1)
    overall = 0.4 * s1 + 0.35 * s2 + 0.25 * s3 + F.when(p % 13 == 0, 2.0).otherwise(0.0)
    coverage = F.size(F.filter(scores, lambda x: x > 0)) / 15 - F.when(s % 13 == 0, 0.2).otherwise(0.0)
    return read(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("ln"), F.col("l_returnflag").alias("judge"), s1.alias("s1"), s2.alias("s2"), s3.alias("s3"), codes.alias("codes"), scores.alias("scores"), overall.alias("overall"), coverage.alias("coverage"),
        words(p % 30 + 1).alias("reasoning"), F.when(s % 7 != 0, "but").otherwise(" ").alias("counter"), F.array(words(s % 9 + 20), F.lit("short one")).alias("quotes"), (s % 11 != 0).alias("supported"),
    )


def _rules(supported: bool):
    one = lambda score: {"score": F.col(score), "words": F.col("said.words"), "counterevidence": F.col("counter"), "quotes": F.col("said.sizes"), "supported": F.col("supported")}
    return sc.grade_rules(F.col("codes"), F.col("scores"), {"d1": one("s1"), "d2": one("s2"), "d3": one("s3")}, rt.WEIGHTS, F.col("overall"), F.col("coverage"), CODES, supported, 13 if supported else 0)


def _grade_sql(v2: bool) -> str:
    per = []
    for k, x in (("d1", "s1"), ("d2", "s2"), ("d3", "s3")):
        bad = f"({x} is null or {x} < 1 or {x} > 100)"
        per += [f"case when {'s % 11 <> 0 and ' if v2 else ''}{bad} then '{k}_score' end", f"case when {'s % 11 = 0 and ' + x + ' is not null' if v2 else 'false'} then '{k}_scored_unsupported' end", f"case when rw < 20 then '{k}_reasoning' end", f"case when s % 7 = 0 then '{k}_counterevidence' end", f"case when qw > 25 then '{k}_quote' end"]
    few = "len(list_filter(scores, lambda x: x > 0)) < 13" if v2 else "false"
    rules = ["case when p % 19 = 0 or p % 23 = 0 then 'missing' end", "case when p % 23 = 0 then 'repeated' end", "case when len(list_filter(scores, lambda x: x > 5)) > 0 then 'criterion_range' end", *per, "case when s3 is not null and p % 13 = 0 then 'overall' end", "case when s % 13 = 0 then 'coverage' end", f"case when {few} then 'too_few_scored' end"]
    return "list_filter([" + ", ".join(rules) + "], lambda x: x is not null)"


@query(f"with {GR}, e as (select k, ln, {_grade_sql(False)} v1, {_grade_sql(True)} v2 from gr), u as (select 'v1' as contract, unnest(v1) error from e union all select 'v2', unnest(v2) from e) select contract, error, count(*) n from u group by all union all select 'v1', 'none', count(*) filter (len(v1) = 0) from e union all select 'v2', 'none', count(*) filter (len(v2) = 0) from e")
def grade_errors(spark, d):
    """How many grades break each rule of the first contract, and of the second, which lets dimensions go without support."""
    # words are counted once for a text, whatever the contracts and dimensions that look at it
    g = _grades(spark, d).select("*", F.explode(F.array(F.struct(sc.word_count(F.col("reasoning")).alias("words"), F.transform("quotes", sc.word_count).alias("sizes")))).alias("said"))
    # counted as conditions, so that no row is made for each error
    counts = []
    for contract in ("v1", "v2"):
        rules = [(name, F.coalesce(bad, F.lit(False))) for name, bad in _rules(contract == "v2")]
        rules.append(("none", ~reduce(lambda a, b: a | b, [bad for _, bad in rules])))
        counts += [F.struct(F.lit(contract).alias("contract"), F.lit(name).alias("error"), F.count_if(bad).alias("n")) for name, bad in rules]
    return g.agg(F.array(*counts).alias("c")).select(F.explode("c").alias("c")).select("c.*").where("n > 0 or error = 'none'")


@query(
    f"""with {GR.replace("l_orderkey k,", "l_returnflag judge, l_orderkey k,")}, q as (select judge, k, unnest(['d1', 'd2']) dimension, qw words from gr where qw > 25) select coalesce(judge, 'all') judge, coalesce(dimension, 'all') dimension, count(*) overruns, max(words)::int longest, count(distinct k) grades from q group by grouping sets ((judge, dimension), (judge), ())"""
)
def quote_cap_report(spark, d):
    """Quotes over the cap by judge and dimension, and the grades that have one."""
    rows = sc.quote_overruns(_grades(spark, d), ["judge", "k"], {"d1": "quotes", "d2": "quotes"})
    g = rows.rollup("judge", "dimension").agg(F.count("*").alias("overruns"), F.max("words").alias("longest"), F.count_distinct("k").alias("grades"))
    return g.withColumn("judge", F.coalesce("judge", F.lit("all"))).withColumn("dimension", F.coalesce("dimension", F.lit("all")))


@query(
    f"""with {G}, s as (select rec, judge, avg(d1) share from g where run = 0 group by all), o as (select a.rec, a.judge, a.share, median(b.share) others, max(b.share) - min(b.share) spread, count(*) k from s a join s b on a.rec = b.rec and a.judge <> b.judge group by all),
 h as (select *, count(*) over (partition by rec) hits from o where k >= 2 and spread <= 6 and abs(share - others) >= 15) select rec, judge, round(share, 6) share, round(others, 6) others from h where hits = 1"""
)
def share_dissent(spark, d):
    """The one judge whose estimate is far from others that agree."""
    s = ratings(spark, d).where("run = 0").groupBy("rec", "judge").agg(F.avg("d1").alias("share"))
    return sc.share_dissent(s, "rec", 15, 6).select("rec", "judge", r6(F.col("share")).alias("share"), r6(F.col("others")).alias("others"))


@query(
    f"""with {G}, j as (select person, rec, judge, case when d1 > 45 then 'NAMESAKE' when d1 > 20 then 'MATCH' when d1 > 10 then 'SURNAME_ONLY' else 'OTHER' end cls, case when d2 = 0 then 0 else d1 end share from g where run = 0 and mode = 'F'),
 a as (select person, rec, count(*) n, count(*) filter (cls <> 'MATCH') nm, count(*) filter (cls = 'NAMESAKE') ns, count(*) filter (share = 0) z, avg(share) ms from j group by all),
 b as (select *, nm >= 2 or (n = 1 and nm = 1) or ns >= 1 r1, z >= 2 or (n = 1 and z = 1) r2, z = 1 and n > 1 and ms >= 10 r5 from a) select person, count(*) recordings, count(*) filter (r1) r1, count(*) filter (r2) r2, count(*) filter (r5) r5, count(*) filter (nm = 1 and n > 1 and not (r1 or r2 or r5)) r6, count(*) filter (r1 or r2) flagged from b group by person"""
)
def wrong_person(spark, d):
    """Recordings of each person by the rules that their judges' answers meet."""
    cls = F.when(F.col("d1") > 45, "NAMESAKE").when(F.col("d1") > 20, "MATCH").when(F.col("d1") > 10, "SURNAME_ONLY").otherwise("OTHER")
    j = ratings(spark, d).where("run = 0 and mode = 'F'").select("person", "rec", cls.alias("class"), F.when(F.col("d2") == 0, 0).otherwise(F.col("d1")).alias("share"))
    g = sc.person_rules(j, ["person", "rec"], 10).groupBy("person")
    return g.agg(F.count("*").alias("recordings"), *[F.count_if(r).alias(r) for r in ("r1", "r2", "r5", "r6", "flagged")])


E = """c as (select o_orderkey id, year(o_orderdate) y, month(o_orderdate) m, day(o_orderdate) dd, o_custkey c, o_orderdate::date od from orders),
 ev as (select id, 'By ' || strftime(od, '%Y-%m-%d') || ', sales exceed ' || (c % 90 + 1)::varchar || ' million or 12%' e, case when c % 7 = 0 then 'Sales will not exceed ' || (c % 90 + 1)::varchar || ' million by ' || strftime(od, '%Y-%m-%d') when c % 7 = 1 then 'By ' || strftime(od + 400, '%Y-%m-%d') || ', sales exceed ' || (c % 90 + 1)::varchar || ' million or 12 percent; less would falsify'
 when c % 7 = 2 then 'Sales exceed ' || (c % 90 + 1)::varchar || ' million and 12%' when c % 7 = 3 then 'By ' || strftime(od, '%Y-%m') || ', sales will or will not exceed 12%' else 'By ' || strftime(od, '%Y-%m-%d') || ', sales exceed ' || (c % 90 + 1)::varchar || ',000 thousand and 12%; never less' end v, c, od from c)"""


@query(
    f"""with {E} select id, array_to_string(list_filter([case when c % 7 = 2 then 'deadline_missing_in_one' when c % 7 = 1 and year(od) <> year(od + 400) then 'deadline_year' end, case when c % 7 in (0, 3) then 'threshold_dropped' end, case when c % 7 = 3 then 'undirected_criterion' when c % 7 = 0 then 'polarity' end], lambda x: x is not null), ',') flags from ev"""
)
def criteria_compare(spark, d):
    """What a verifier's criterion changes in the extractor's: deadline, thresholds, direction."""
    c, od = F.col("o_custkey"), F.to_date("o_orderdate")
    n, day = (c % 90 + 1).cast("string"), lambda x, f="yyyy-MM-dd": F.date_format(x, f)
    k = c % 7
    e = F.concat(F.lit("By "), day(od), F.lit(", sales exceed "), n, F.lit(" million or 12%"))
    v = F.when(k == 0, F.concat(F.lit("Sales will not exceed "), n, F.lit(" million by "), day(od)))
    v = v.when(k == 1, F.concat(F.lit("By "), day(F.date_add(od, 400)), F.lit(", sales exceed "), n, F.lit(" million or 12 percent; less would falsify")))
    v = v.when(k == 2, F.concat(F.lit("Sales exceed "), n, F.lit(" million and 12%"))).when(k == 3, F.concat(F.lit("By "), day(od, "yyyy-MM"), F.lit(", sales will or will not exceed 12%")))
    v = v.otherwise(F.concat(F.lit("By "), day(od), F.lit(", sales exceed "), n, F.lit(",000 thousand and 12%; never less")))
    rows = read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), e.alias("e"), v.alias("v"))
    rows = rows.select("id", F.explode(F.array(F.struct("e", "v", *[f(F.col(x)).alias(f"{name}_{x}") for x in ("e", "v") for name, f in (("by", dt.criterion_deadline), ("t", lambda t: sc.thresholds(t, dt.DATE)), ("neg", sc.polarity))]))).alias("x")).select("id", "x.*")
    a, b = F.col("by_e"), F.col("by_v")
    late = F.when(a.isNull() & b.isNull(), None).when(a.isNull() | b.isNull(), "deadline_missing_in_one").when(a["year"] != b["year"], "deadline_year").when(a["month"] != b["month"], "deadline_month").when(a["day"] != b["day"], "deadline_day")
    dropped = F.when(F.size(F.array_except("t_e", "t_v")) > 0, "threshold_dropped")
    undirected = F.col("e").rlike(f"(?i){sc.UNDIRECTED}") | F.col("v").rlike(f"(?i){sc.UNDIRECTED}")
    turned = F.when(undirected, "undirected_criterion").when(F.col("neg_e") != F.col("neg_v"), "polarity")
    return rows.select("id", F.array_join(F.array_compact(F.array(late, dropped, turned)), ",").alias("flags"))


@query(
    f"""with {FC}, m as (select id, person, kind, p, case when kind in ('purchase', 'view') then 'exact' when kind = 'error' then 'none' else 'proxy' end mt, case id % 3 when 0 then 'high' when 1 then 'medium' else 'low' end conf, case when id % 2 = 0 then 'a' else 'b' end platform, said from f),
 x as (select *, case when mt = 'exact' and row_number() over (partition by person, platform, said, mt order by list_position(['high', 'medium', 'low'], conf), id) > 1 then 'proxy' else mt end match from m where mt <> 'none'), c as (select distinct person, said from f),
 s as (select c.person, c.said, count(x.id) n, count(*) filter (match = 'exact') exact, count(*) filter (match = 'proxy') proxies, coalesce(bool_or(match = 'exact' and id % 5 <> 0), false) seen from c left join x on x.person = c.person and x.said = c.said group by all)
 select person, said, exact, proxies, case when n = 0 then 'no_match' when exact > 0 and seen then 'matched' else 'unavailable' end status, case when n = 0 then 'no_candidates' when exact > 0 and seen then null when exact > 0 then 'no_observation_before_cutoff' else 'proxy_only' end why from s"""
)
def market_status(spark, d):
    """Per person and day: exact and proxy markets after one exact match for each platform, and what that makes of the price."""
    f = forecasts(spark, d)
    match = F.when(F.col("kind").isin("purchase", "view"), "exact").when(F.col("kind") == "error", "none").otherwise("proxy")
    conf = F.when(F.col("id") % 3 == 0, "high").when(F.col("id") % 3 == 1, "medium").otherwise("low")
    rows = f.select(F.struct("person", "said").alias("claim"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("platform"), F.col("id").alias("market"), match.alias("match"), conf.alias("confidence"))
    x = sc.one_exact(rows, "claim").groupBy("claim").agg(F.count("*").alias("n"), F.count_if(F.col("match") == "exact").alias("exact"), F.count_if(F.col("match") == "proxy").alias("proxies"), F.bool_or((F.col("match") == "exact") & (F.col("market") % 5 != 0)).alias("seen"))
    s = rows.select("claim").distinct().join(x, "claim", "left").fillna(0, ["n", "exact", "proxies"]).fillna(False, ["seen"])
    status, why = sc.consensus_status(F.col("claim.said"), F.col("n") > 0, F.col("exact") > 0, F.col("proxies"), F.col("seen"))
    return s.select("claim.person", "claim.said", "exact", "proxies", status.alias("status"), why.alias("why"))


@query(f"with {FC} select id, round(p, 6) yes, case when id % 3 = 0 then round(1 - round(p, 6), 6) else round(p, 6) end claim, round(((p - 0.01) + (p + 0.02)) / 2, 6) midpoint, epoch(timestamp '2024-02-01') - epoch(date_trunc('second', ts)) age from f")
def market_observations(spark, d):
    f = forecasts(spark, d)
    o = sc.observation(F.col("p"), F.col("id") % 3 == 0, F.col("p") - 0.01, F.col("p") + 0.02, F.col("ts").cast("timestamp"), F.lit("2024-02-01 00:00:00").cast("timestamp"))
    return f.select("id", o.alias("o")).select("id", "o.yes", "o.claim", "o.midpoint", "o.age")


PAIRS = [("the", "teh"), ("license", "licence"), ("no such words", "none"), ("rights", "right")]


@query(
    "with r0 as (select doc_id, text t from documents), "
    + ", ".join(rf"r{k + 1} as (select *, len(regexp_extract_all(t, '(?i)\b{w}\b'))::int n{k}, regexp_replace(t, '(?i)\b{w}\b', '{r}', 'g') t{k + 1} from (select * exclude (t), t{k} t from r{k}))" if k else rf"r1 as (select *, len(regexp_extract_all(t, '(?i)\b{w}\b'))::int n0, regexp_replace(t, '(?i)\b{w}\b', '{r}', 'g') t1 from r0)" for k, (w, r) in enumerate(PAIRS))
    + " select doc_id, n0, n1, n2, n3, md5(t4) text_md5 from r4"
)
def repaired_texts(spark, d):
    """Known mishearings replaced in order, and how often each was, 0 too."""
    text, counts = sc.repaired(F.col("text"), PAIRS)
    rows = read(spark, d, "documents").select("doc_id", F.explode(F.array(F.struct(text.alias("t"), counts.alias("c")))).alias("x"))
    return rows.select("doc_id", *[F.get("x.c", F.lit(k)).alias(f"n{k}") for k in range(len(PAIRS))], F.md5("x.t").alias("text_md5"))


@query(
    r"""with n as (select source, arg_min(regexp_extract(text, '([A-Za-z]{2,}\s+[A-Za-z]{2,})', 1), doc_id) name from documents where lang = 'en' group by source), w as (select source, list_filter(string_split_regex(trim(name), '\s+'), lambda x: x <> '') w from n),
 v as (select source, list_distinct(list_concat(list_concat([array_to_string(w, ' ')], case when len(w) >= 2 then [array_to_string(list_slice(w, -2, -1), ' ')] else [] end), list_filter(w, lambda x: length(x) >= 4))) v from w),
 s as (select source, list(x order by -length(x), x) v from (select source, unnest(v) x from v) group by source),
 p as (select source, '(?i)\b(?:' || array_to_string(list_transform(v, lambda x: regexp_replace(x, '([][.*+?()|{}^$-])', '\\\1', 'g')), '|') || ')\b' pat from s)
 select doc_id, len(regexp_extract_all(t, '\[NAME\]'))::int tokens, md5(t) text_md5 from (select doc_id, regexp_replace(regexp_replace(text, pat, '[NAME]', 'g'), '\[NAME\](?:\s+\[NAME\])+', '[NAME]', 'g') t from documents d join p on p.source = d.source where lang = 'en')"""
)
def redacted_texts(spark, d):
    """Texts without the variants of their person's name, here the first two words of the source's first English document."""
    docs = read(spark, d, "documents").where("lang = 'en'")
    names = docs.where("text is not null").groupBy("source").agg(F.min_by(F.regexp_extract("text", rf"([A-Za-z]{{2,}}{sc.SPACE}+[A-Za-z]{{2,}})", 1), "doc_id").alias("name")).select("source", sc.name_variants(F.col("name")).alias("v"))
    rows = docs.join(names, "source").select("doc_id", sc.redacted(F.col("text"), F.col("v"), "[NAME]").alias("t"))
    return rows.select("doc_id", F.regexp_count("t", F.lit(r"\[NAME\]")).alias("tokens"), F.md5("t").alias("text_md5"))


HEDGE = {"hedges": r"\b(may|might|perhaps|could)\b", "claims": r"\b(will|shall|must)\b", "licenses": r"\b(license|licensed|rights)\b"}


@query("select doc_id, " + ", ".join(f"len(regexp_extract_all(regexp_replace(coalesce(text, ''), '[^\\x00-\\x7F]', 'q', 'g'), '(?i){p}'))::int {n}" for n, p in HEDGE.items()) + r", length(lower(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g')))::int letters, md5(lower(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g'))) letters_md5 from documents")
def lexical_hits(spark, d):
    """Words of each category in documents, and their stream of letters."""
    stream = sc.letter_stream(F.col("text"))
    return read(spark, d, "documents").select("doc_id", *[c.alias(n) for n, c in sc.lexical_hits(F.col("text"), HEDGE).items()], F.length(stream).alias("letters"), F.md5(stream).alias("letters_md5"))


@query(
    r"""with u as (select page_id, url, case when page_id % 3 = 0 then 'https://web.archive.org/web/20240101000000id_/' || url when page_id % 3 = 1 then 'https://www.youtube.com/watch?v=' || substr(md5(page_id::varchar), 1, 11) || '&t=5' else 'https://youtu.be/' || substr(md5((page_id - page_id % 2)::varchar), 1, 11) end a, substr(md5(page_id::varchar), 1, 11) v from pages)
 select page_id, regexp_replace(a, '^https?://web\.archive\.org/web/\d+(?:[a-z]{2}_)?/', '') as page, case when page_id % 3 = 1 then 'the recording itself' when page_id % 3 = 2 and page_id % 2 = 0 then 'a short address of the recording' end own from u"""
)
def page_addresses(spark, d):
    """Addresses taken out of archives, and whether they are the recording's own page."""
    i = F.col("page_id")
    key = lambda c: F.substring(F.md5(c.cast("string")), 1, 11)
    a = F.when(i % 3 == 0, F.concat(F.lit("https://web.archive.org/web/20240101000000id_/"), "url")).when(i % 3 == 1, F.concat(F.lit("https://www.youtube.com/watch?v="), key(i), F.lit("&t=5"))).otherwise(F.concat(F.lit("https://youtu.be/"), key(i - i % 2)))
    p = read(spark, d, "pages").select("page_id", a.alias("a"), key(i).alias("v"))
    return p.select("page_id", sc.unwrapped(F.col("a")).alias("page"), sc.own_page(sc.unwrapped(F.col("a")), F.col("v")).alias("own"))


@query(None)
def blinded_texts(spark, d):
    """Texts without their source's person, here named by the first two words of the source's first document, with words of its last one as affiliation and handle; misheard forms too."""
    docs = read(spark, d, "documents").select("doc_id", "source", "text")
    two = F.regexp_extract("text", r"([A-Za-z]{2,}\s+[A-Za-z]{2,})", 1)
    people = docs.groupBy(F.col("source").alias("subject")).agg(F.min_by(two, "doc_id").alias("name"), F.max_by(two, "doc_id").alias("other"))
    people = people.select("subject", "name", F.array(F.substring_index("other", " ", -1)).alias("handles"), F.array("other").alias("affiliations"), F.array(F.concat("name", F.lit(" Show"))).alias("aliases"))
    known = vo.vocabulary(read(spark, d, "conversations").select("text"), vo.tokens)
    texts = docs.select(F.col("doc_id").alias("key"), F.col("source").alias("subject"), "text")
    anchors = texts.select("key", "subject").join(people, "subject").select("key", F.explode(F.split("name", r"\s+")).alias("anchor"))
    heard = lk.misheard(texts, "key", anchors, known).select("key", "word", F.lit("subject").alias("role"))
    got = bl.blind_texts(texts, bl.person_forms(people, known), heard=heard)
    return got.select(F.col("key").alias("doc_id"), "subjects", "affiliations", "kept", F.md5("text").alias("text_md5"))
