"""Queries of pages and of names that were heard wrongly."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillboard.operators import likeness as lk, pages as pg, screens as sc, vocabulary as vo
from quillboard.plans.oracles import F as FC, NORM
from quillboard.plans.registry import query
from quillboard.sources.tables import forecasts, read


@query(
    """select page_id, case when page_id % 4 in (1, 2) then strftime(date '2024-01-01' + (page_id % 300)::int, '%Y-%m-%dT00:00:00Z') end published, case when page_id % 4 = 1 then strftime(timestamp '2024-01-01 01:30:00' + to_days((page_id % 300)::int) - interval 2 hour, '%Y-%m-%dT%H:%M:%SZ') end uploaded,
 case when page_id % 4 = 0 then 'none' when page_id % 4 = 3 then 'ambiguous' else 'ok' end state, case when page_id % 5 = 0 then 'first ' || page_id::varchar || chr(10) || 'second' end body from pages"""
)
def page_dates(spark, d):
    """Dates and bodies of pages with linked data and embedded text added: no transcript, one, or several that claim it."""
    i = F.col("page_id")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (i % 300).cast("int"))
    one = F.concat(F.lit('<script type="application/ld+json">{"transcript": "t", "datePublished": "'), day.cast("string"), F.lit('"'), F.when(i % 4 == 1, F.concat(F.lit(', "uploadDate": "'), day.cast("string"), F.lit('T01:30:00+02:00"'))).otherwise(""), F.lit("}</script>"))
    other = F.lit('<script type="application/ld+json">{"name": "x", "datePublished": "1999-01-01"}</script><script type="application/ld+json">{broken</script>')
    data = F.when(i % 4 == 0, other).when(i % 4 == 3, F.concat(one, other, one)).otherwise(F.concat(other, one))
    body = F.when(i % 5 == 0, F.concat(F.lit('<script id="__NEXT_DATA__">{"blocks": [{"children": [{"text": "first "}, {"text": "'), i.cast("string"), F.lit('"}]}, {"children": [{"text": "second"}]}]}</script>'))).otherwise("")
    p = read(spark, d, "pages").select("page_id", F.concat(F.coalesce("html", F.lit("")), data, body).alias("html"))
    return p.select("page_id", pg.owned_dates(F.col("html")).alias("o"), pg.block_text(F.col("html")).alias("body")).select("page_id", "o.*", "body")


@query(
    f"""with d as (select doc_id, ' ' || {NORM.format("text")} || ' ' t, {NORM.format("substr(text, 40, 60)")} e from documents) select doc_id, case when e = '' then 0 else strpos(t, ' ' || e || ' ') end::int place from d"""
)
def excerpt_places(spark, d):
    """Where an excerpt of each document stands in it; one that cuts words in two is not found."""
    docs = read(spark, d, "documents")
    return docs.select("doc_id", pg.excerpt_place(F.col("text"), F.substring("text", 40, 60)).alias("place"))


@query(
    r"""with c as (select conv_id, string_agg(case when turn % 3 = 0 then 'Ann Lee: ' when turn % 3 = 1 then 'Bo: ' else 'none ' end || regexp_replace(text, '\s+', ' ', 'g'), chr(10) order by turn, role, text) t from conversations group by conv_id),
 l as (select conv_id, t, regexp_extract_all(t, '(?m)^(?:\[\d\d:\d\d:\d\d\]\s*)?([A-Z][\w.''-]*(?: [A-Z][\w.''-]*){0,3}):', 1) l from c), u as (select conv_id, unnest(l) x, generate_subscripts(l, 1) i from l), v as (select conv_id, x, min(i) i from u group by all)
 select conv_id, string_agg(x, ',' order by i) labels from v group by conv_id"""
)
def label_names(spark, d):
    """Names that label the turns of each conversation, in order."""
    named = F.when(F.col("turn") % 3 == 0, "Ann Lee: ").when(F.col("turn") % 3 == 1, "Bo: ").otherwise("none ")
    c = read(spark, d, "conversations").select("conv_id", F.struct("turn", "role", "text", F.concat(named, F.regexp_replace("text", r"\s+", " ")).alias("t")).alias("s"))
    per = c.groupBy("conv_id").agg(F.array_join(F.array_sort(F.collect_list("s"))["t"], "\n").alias("t"))
    return per.select("conv_id", F.array_join(sc.speaker_labels(F.col("t")), ",").alias("labels")).where("labels <> ''")


@query(
    f"""with {FC}, m as (select id, ts, epoch(timestamp '2024-01-20') - epoch(date_trunc('second', ts)) + case when id % 9 = 0 then 1 else 0 end age, case when id % 13 = 0 then 1.2 else p end yes, id % 3 = 0 inv, case when id % 3 = 0 and id % 6 <> 0 then p when id % 3 = 0 then 1 - p else p end claim from f)
 select id, array_to_string(list_filter([case when ts >= timestamp '2024-01-20' then 'after_cutoff' end, case when id % 9 = 0 then 'age' end, case when abs(claim - case when inv then 1 - yes else yes end) > 1e-6 then 'direction' end, case when yes > 1 then 'range' end], lambda z: z is not null), ',') errors from m"""
)
def consensus_errors(spark, d):
    """Rules that stored prices break, some of them on purpose."""
    f = forecasts(spark, d)
    i, cut, ts = F.col("id"), F.lit("2024-01-20 00:00:00").cast("timestamp"), F.col("ts").cast("timestamp")
    age = F.unix_timestamp(cut) - F.unix_timestamp(ts) + F.when(i % 9 == 0, 1).otherwise(0)
    yes = F.when(i % 13 == 0, 1.2).otherwise(F.col("p"))
    claim = F.when((i % 3 == 0) & (i % 6 != 0), F.col("p")).when(i % 3 == 0, 1 - F.col("p")).otherwise(F.col("p"))
    return f.select("id", F.array_join(pg.consensus_errors(cut, ts, age, yes, claim, i % 3 == 0), ",").alias("errors"))


@query(f"with {FC} select id, case when id % 2 = 0 then (ts - interval 5 hour)::date else ts::date end as day from f")
def zone_days(spark, d):
    """Days of moments: spoken ones five hours west of UTC, publications in UTC."""
    return forecasts(spark, d).select("id", pg.zone_day(F.col("ts").cast("timestamp"), F.lit("-05:00"), F.col("id") % 2 == 0).alias("day"))


#: Letters in matching blocks of pairs q(a, b), table m: each step takes the longest common stretch out of every open pair.
BLOCKS = """bl(a0, b0, a, b, n) as (select a, b, a, b, 0 from q union all select a0, b0, s.a, s.b, s.n from (select a0, b0, unnest(case when z.n = 0 then [] else [{'a': a[1 : z.i - 1], 'b': b[1 : instr(b, a[z.i : z.i + z.n - 1]) - 1], 'n': z.n}, {'a': a[z.i + z.n : length(a)], 'b': b[instr(b, a[z.i : z.i + z.n - 1]) + z.n : length(b)], 'n': 0}] end) s
 from (select *, list_aggregate(list_transform(range(1, length(a) + 1), lambda i: {'n': coalesce(list_max(list_filter(range(1, length(a) - i + 2), lambda k: instr(b, a[i : i + k - 1]) > 0)), 0), 'j': -i, 'i': i}), 'max') z from bl where a <> '' and b <> ''))), m as (select a0 a, b0 b, sum(n) n from bl group by all)"""
SKELETON = """array_to_string(list_transform(list_filter(list_transform(generate_series(1, length(s0)), lambda i: {{'c': s0[i], 'i': i}}), lambda z: z.i = 1 or not contains('aeiouy', z.c)), lambda z: z.c), '')"""


@query(
    rf"""with recursive d as (select doc_id, source, regexp_replace(text, '[^\x00-\x7F\x{{2019}}]', '0', 'g') text from documents), n0 as (select source, arg_min(regexp_extract(text, '\b([A-Z][a-z]{{4,}})\b', 1), doc_id) anchor from d group by source), nm as (select source, anchor, lower(anchor) name from n0 where length(anchor) >= 4),
 w as (select doc_id, source, unnest(regexp_extract_all(text, '\b([A-Za-z][A-Za-z''\x{{2019}}-]{{3,}})\b', 1)) raw from d), kn as (select distinct unnest(regexp_extract_all(lower(text), '([a-z'']+)', 1)) word from conversations),
 p as (select doc_id, source, lower(raw) word from w group by all having count(*) <= 25 and bool_or(regexp_matches(raw, '^[A-Z]')) and not regexp_matches(lower(raw), '[''\x{{2019}}]') and lower(raw) not in (select word from kn)),
 c0 as (select distinct word, name from p join nm using (source) where word <> name and abs(length(word) - length(name)) <= 3), st as (select distinct x from (select word x from c0 union all select name from c0)),
 s1 as (select x, translate(replace(replace(regexp_replace(lower(x), '[^a-z]+', '', 'g'), 'ph', 'f'), 'x', 'ks'), 'cqz', 'kks') s0 from st), s2 as (select x, string_split({SKELETON.format()}, '') c from s1), sk as (select x, array_to_string(list_filter(c, lambda y, i: i = 1 or y <> c[i - 1]), '') s from s2),
 q as (select distinct word a, name b from c0 union select distinct a.s, b.s from c0 join sk a on a.x = word join sk b on b.x = name), {BLOCKS},
 ok as (select word, name from c0 join sk a on a.x = word join sk b on b.x = name join m on m.a = word and m.b = name join m h on h.a = a.s and h.b = b.s where 2 * m.n / (length(word) + length(name)) >= 0.64 and case when length(a.s) + length(b.s) = 0 then 1 else 2 * h.n / (length(a.s) + length(b.s)) end >= 0.8)
 select doc_id, p.word, min(anchor) anchor from p join ok using (word) join nm on nm.source = p.source and nm.name = ok.name group by all"""
)
def misheard_names(spark, d):
    """Capitalised words of documents that are their source's name misheard, here its first capitalised word of five letters or more."""
    docs = read(spark, d, "documents").select("doc_id", "source", "text")
    names = docs.groupBy("source").agg(F.min_by(F.regexp_extract("text", r"\b([A-Z][a-z]{4,})\b", 1), "doc_id").alias("anchor"))
    known = vo.vocabulary(read(spark, d, "conversations").select("text"), vo.tokens)
    return lk.misheard(docs, "doc_id", docs.select("doc_id", "source").join(names, "source"), known)
