"""Queries of quotes and speakers over the conversations in their role as transcripts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from quillboard.operators import grounding as gr, transcript as tr, turns as tn
from quillboard.plans.registry import query
from quillboard.sources.tables import read, transcripts, turns

T = r"""t as (select conv_id, row_number() over (partition by conv_id order by turn, role, trim(regexp_replace(text, '\s+', ' ', 'g'))) - 1 k, role, trim(regexp_replace(text, '\s+', ' ', 'g')) words from conversations),
 u as (select *, printf('[%02d:%02d:00]', k // 60, k % 60) mark, length(words) + 11 len from t), v as (select *, coalesce(sum(len + 1) over (partition by conv_id order by k rows between unbounded preceding and 1 preceding), 0)::bigint as off from u)"""
#: each turn's words one by one, with their places in the transcript
W = r"""w0 as (select conv_id, k, mark, off, unnest(regexp_extract_all(words, '[^\p{L}\p{N}]*[\p{L}\p{N}]+')) piece, generate_subscripts(regexp_extract_all(words, '[^\p{L}\p{N}]*[\p{L}\p{N}]+'), 1) i from v),
 w1 as (select *, off + 11 + sum(length(piece)) over (partition by conv_id, k order by i) e, lower(regexp_extract(piece, '[\p{L}\p{N}]+$')) w from w0), w as (select *, (e - length(w))::bigint s, row_number() over (partition by conv_id order by k, i) p from w1),
 ws as (select conv_id, list(w order by p) ws from w group by conv_id)"""
Q = r"""q0 as (select conv_id, k, mark, list_slice(regexp_extract_all(lower(words), '[\p{L}\p{N}]+'), 1, 6) qw from v), q as (select * from q0 where len(qw) > 0),
 hit as (select q.conv_id, q.k, q.mark hint, len(qw) n, w.p, w.s, w.mark from q join ws on ws.conv_id = q.conv_id join w on w.conv_id = q.conv_id and w.w = q.qw[1] and list_slice(ws.ws, w.p, w.p + len(q.qw) - 1) = q.qw),
 one as (select *, count(*) over (partition by conv_id, k) occ, count(*) filter (mark = hint) over (partition by conv_id, k) hinted from hit),
 loc as (select o.conv_id, o.k, any_value(o.occ) occ, max(case when o.occ = 1 or (o.hinted = 1 and o.mark = o.hint) then o.s end) as start, max(case when o.occ = 1 or (o.hinted = 1 and o.mark = o.hint) then x.e end) as fin, max(case when o.occ = 1 or (o.hinted = 1 and o.mark = o.hint) then o.mark end) mark
 from one o join w x on x.conv_id = o.conv_id and x.p = o.p + o.n - 1 group by o.conv_id, o.k)"""


def _quotes(spark, d) -> DataFrame:
    """The first six words of every turn, with the turn's mark as the hint."""
    words = F.slice(F.regexp_extract_all("words", F.lit(r"([\p{L}\p{N}]+)"), 1), 1, 6)
    return turns(spark, d).select("conv_id", F.col("k").alias("quote_id"), F.array_join(words, " ").alias("quote"), F.col("mark").alias("hint")).where("quote <> ''")


def _located(spark, d) -> DataFrame:
    return gr.locate_quotes(transcripts(spark, d), _quotes(spark, d), "conv_id")


@query(f"with {T}, {W}, {Q} select conv_id, k quote_id, start, fin::bigint as \"end\", occ occurrences, case when start is null then 'ambiguous_no_hint' end error, mark, split_part(trim(mark, '[]'), ':', 1)::int * 3600 + split_part(trim(mark, '[]'), ':', 2)::int * 60 as seconds from loc")
def quote_places(spark, d):
    """Where each turn's first words stand in its conversation, and the mark and second before them."""
    return _located(spark, d).withColumn("seconds", gr.mark_seconds(F.col("mark")))


@query(
    rf"""with {T}, {W}, {Q}, x as (select conv_id, string_agg(mark || ' ' || words, chr(10) order by k) txt from v group by conv_id),
 c as (select loc.conv_id, k, regexp_extract_all(substr(txt, 1, start), '\S+') b, regexp_extract_all(substr(txt, fin::bigint + 1), '\S+') a, regexp_extract_all(regexp_replace(substr(txt, start + 1, fin::bigint - start), '\[\d\d:\d\d:\d\d\]', ' ', 'g'), '\S+') m from loc join x on x.conv_id = loc.conv_id where start is not null)
 select conv_id, k quote_id, least(len(b), 8)::int words_before, least(len(a), 8)::int words_after, len(m)::int quote_words, md5(array_to_string(list_slice(b, -8, -1), ' ')) before_md5, md5(array_to_string(list_slice(a, 1, 8), ' ')) after_md5 from c"""
)
def quote_context(spark, d):
    """Eight words before and after each quote that was found, and how many words it has."""
    rows = _located(spark, d).where("start is not null").join(transcripts(spark, d), "conv_id")
    before, after = gr.context(F.col("text"), F.col("start").cast("int"), F.col("end").cast("int"), 8)
    plain = lambda c: F.regexp_replace(c, r"\s+", " ")
    count = lambda c: F.size(F.regexp_extract_all(c, F.lit(r"(\S+)"), 1))
    quote = F.substring("text", F.col("start").cast("int") + 1, (F.col("end") - F.col("start")).cast("int"))
    return rows.select("conv_id", "quote_id", count(before).alias("words_before"), count(after).alias("words_after"), gr.quote_words(quote).alias("quote_words"), F.md5(plain(before)).alias("before_md5"), F.md5(plain(after)).alias("after_md5"))


def _offsets(spark, d) -> DataFrame:
    """Each turn with the place of its mark in the transcript."""
    before = Window.partitionBy("conv_id").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    t = turns(spark, d).withColumn("len", F.length("words") + 11)
    return t.withColumn("off", F.coalesce(F.sum(F.col("len") + 1).over(before), F.lit(0)))


@query(
    f"""with {T}, {W}, {Q}, g as (select conv_id, k id, off + 11 s, off + 11 + greatest(length(words) // 3, 1) e from v where k % 2 = 0),
 m as (select loc.conv_id, loc.k, g.id, (least(fin, g.e) - greatest(start, g.s)) / (g.e - g.s) share, g.s from loc join g on g.conv_id = loc.conv_id and start < g.e and g.s < fin where start is not null),
 b as (select conv_id, k, arg_max(id, (share, -s)) gold, max(share) share from m where share >= 0.5 group by all), a as (select conv_id, count(*) accepted from loc where start is not null group by conv_id),
 p as (select conv_id, count(*) matched, count(distinct gold) hit from b group by conv_id), gg as (select conv_id, count(*) gold from g group by conv_id)
 select gg.conv_id, gold, coalesce(accepted, 0) accepted, coalesce(matched, 0) matched, gold - coalesce(hit, 0) missed, round(coalesce(matched, 0) / accepted, 6) as "precision", round(coalesce(hit, 0) / gold, 6) recall from gg left join a on a.conv_id = gg.conv_id left join p on p.conv_id = gg.conv_id"""
)
def gold_eval(spark, d):
    """Located quotes against the first third of every other turn as gold spans: matches, precision and recall."""
    spans = _located(spark, d).where("start is not null").select("conv_id", F.col("quote_id").alias("id"), "start", "end")
    start = F.col("off") + 11
    gold = _offsets(spark, d).where("k % 2 = 0").select("conv_id", F.col("k").alias("id"), start.alias("start"), (start + F.greatest(F.floor(F.length("words") / 3), F.lit(1))).alias("end"))
    per = gr.best_overlap(spans, gold, "conv_id").groupBy("conv_id").agg(F.count("*").alias("accepted"), F.count("gold_id").alias("matched"), F.count_distinct("gold_id").alias("hit"))
    all_ = gold.groupBy("conv_id").agg(F.count("*").alias("gold")).join(per, "conv_id", "left").fillna(0, ["accepted", "matched", "hit"])
    return all_.select("conv_id", "gold", "accepted", "matched", (F.col("gold") - F.col("hit")).alias("missed"), F.round(F.col("matched") / F.nullif("accepted", F.lit(0)), 6).alias("precision"), F.round(F.col("hit") / F.col("gold"), 6).alias("recall"))


K = r"""kd as (select conv_id, k, role, x, case when regexp_matches(x, '^\[\d{1,2}:\d{2}:\d{2}\]$') then 'timestamp' when x = '>>' then 'turn' when regexp_matches(x, '^\[[^\]]*\]$') then 'gap' when not regexp_matches(x, '[\p{L}\p{N}]') then 'punctuation' else 'speech' end kind
 from (select conv_id, k, role, unnest(regexp_extract_all(mark || ' ' || words, '\S+')) x from v))"""


@query(f"with {T}, {K} select conv_id, count(*) filter (kind = 'timestamp') timestamps, count(*) filter (kind = 'punctuation') punctuation, count(*) filter (kind = 'gap') gaps, count(*) filter (kind = 'speech') speech from kd group by conv_id")
def token_kinds(spark, d):
    """How many tokens of each kind a conversation has."""
    kinds = transcripts(spark, d).select("conv_id", gr.token_kinds(F.col("text")).alias("x"))
    n = lambda k: F.size(F.filter("x", lambda t: t == k)).cast("long")
    return kinds.select("conv_id", n("timestamp").alias("timestamps"), n("punctuation").alias("punctuation"), n("gap").alias("gaps"), n("speech").alias("speech"))


R = """rg as (select conv_id, k, role, len(string_split(words, ' ')) n, (sum(len(string_split(words, ' '))) over (partition by conv_id order by k) - len(string_split(words, ' ')))::bigint a from v)"""


@query(
    f"""with {T}, {R}, sp as (select conv_id, k id, a + n // 2 a, a + n // 2 + 12 z from rg), l as (select * from rg where k % 5 <> 4),
 m as (select sp.conv_id, sp.id, sp.a, sp.z, coalesce(sum(least(z, l.a + n) - greatest(sp.a, l.a)), 0) covered, count(distinct role) who, min(role) one from sp left join l on l.conv_id = sp.conv_id and sp.a < l.a + n and l.a < z group by all)
 select conv_id, id, a::bigint a, z::bigint z, case when covered < z - a then 'unlabelled' when who > 1 then 'both' else one end speaker from m"""
)
def span_speakers(spark, d):
    """Who speaks in the twelve words from the middle of each turn on; every fifth turn is unlabelled."""
    before = Window.partitionBy("conv_id").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    t = turns(spark, d).withColumn("n", F.size(F.split("words", " ")).cast("long"))
    t = t.withColumn("a", F.coalesce(F.sum("n").over(before), F.lit(0)))
    middle = F.col("a") + F.floor(F.col("n") / 2)
    spans = t.select("conv_id", F.col("k").alias("id"), middle.alias("a"), (middle + 12).alias("z"))
    ranges = t.where("k % 5 <> 4").select("conv_id", F.col("a").alias("start"), (F.col("a") + F.col("n")).alias("end"), F.col("role").alias("speaker"))
    return gr.speaker_of(spans, ranges, "conv_id")


@query(
    f"""with {T}, h as (select conv_id, k, role from v), arms(arm) as (values ('a'), ('b'), ('c')), l as (select arm, conv_id, k, case when arm = 'a' or k % 3 = 0 or (arm = 'b' and k % 3 = 1) then role else 'user' end as label from h, arms where not (arm = 'c' and conv_id % 7 = 0)),
 full_ as (select conv_id from l group by conv_id having count(distinct arm) = 3)
 select arm, count(*) words, round(avg((l.label = h.role)::int), 6) accuracy from l join h on h.conv_id = l.conv_id and h.k = l.k where l.conv_id in (select conv_id from full_) group by arm"""
)
def segmentation_score(spark, d):
    """Three labellings of the turns against the true speakers; the third one misses some conversations."""
    h = turns(spark, d).select("conv_id", F.col("k").alias("word"), F.col("role").alias("label"))
    arm = h.select(F.explode(F.array(F.lit("a"), F.lit("b"), F.lit("c"))).alias("arm"), "conv_id", "word", "label").where("not (arm = 'c' and conv_id % 7 = 0)")
    right = (F.col("arm") == "a") | (F.col("word") % 3 == 0) | ((F.col("arm") == "b") & (F.col("word") % 3 == 1))
    return gr.segmentation(arm.withColumn("label", F.when(right, F.col("label")).otherwise("user")), h, ["conv_id"])


@query(
    f"""with {T}, {R}, m as (select conv_id, a word, k * 60 sec from rg where k % 2 = 0), p as (select conv_id, k, a + n // 2 word from rg),
 b as (select p.*, arg_max(m.word, m.word) filter (m.word <= p.word) pw, arg_max(sec, m.word) filter (m.word <= p.word) ps, arg_min(m.word, m.word) filter (m.word >= p.word) nw, arg_min(sec, m.word) filter (m.word >= p.word) ns from p left join m on m.conv_id = p.conv_id group by all)
 select conv_id, k, word::bigint word, round(coalesce(ps + (ns - ps) * (word - pw) / nullif(nw - pw, 0), ps, ns)::double, 6) as second from b"""
)
def play_times(spark, d):
    """The second at which each turn's middle word is said, by the marks of every other turn."""
    before = Window.partitionBy("conv_id").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    t = turns(spark, d).withColumn("n", F.size(F.split("words", " ")).cast("long"))
    t = t.withColumn("a", F.coalesce(F.sum("n").over(before), F.lit(0)))
    marks = t.where("k % 2 = 0").select("conv_id", F.col("a").alias("word"), (F.col("k") * 60).alias("second"))
    words = t.select("conv_id", "k", (F.col("a") + F.floor(F.col("n") / 2)).alias("word"))
    return words.join(gr.play_second(marks, words.select("conv_id", "word").distinct(), "conv_id"), ["conv_id", "word"]).select("conv_id", "k", "word", F.round("second", 6).alias("second"))


#: A token's word in the other engine: letters, marks, digits, low lines and apostrophes in lower case.
PLAIN_WORD = r"case when regexp_full_match({t}, '\[\d{{2}}:\d{{2}}:\d{{2}}\]|>{{2,}}') then '' else regexp_replace(lower({t}), '[^\pL\pM\pN_'']', '', 'g') end"
SPLIT = r"list_filter(string_split_regex({t}, '\s+'), lambda z: z <> '')"


@query(
    f"""with {T}, x as (select conv_id, string_agg(mark || ' ' || words, chr(10) order by k) txt from v group by conv_id), tk as (select conv_id, {SPLIT.format(t='txt')} toks from x), nm as (select conv_id, list_transform(toks, lambda y: {PLAIN_WORD.format(t='y')}) w, len(toks) size from tk),
 s0 as (select conv_id, k, role, {SPLIT.format(t='words')} ws from v), s1 as (select *, sum(1 + len(ws)) over (partition by conv_id order by k) - 1 - len(ws) s from s0),
 q as (select s1.*, w, size, greatest(0, least((s - (s1.conv_id + k) % 45)::int, size - 1)) m, list_filter(list_transform(ws[1:6], lambda y: {PLAIN_WORD.format(t='y')}), lambda y: y <> '')[1:5] want from s1 join nm on nm.conv_id = s1.conv_id),
 h as (select *, case when len(want) > 0 then list_filter(range(m, least(m + 40, size)), lambda i: w[i + 1] <> '' and list_filter(w[i + 1 : i + len(want) + 3], lambda y: y <> '')[1:len(want)] = want)[1] end h from q),
 r as (select conv_id, k n, coalesce(h, m)::int "start", role speaker, h is not null found, size, lead(coalesce(h, m)::int) over (partition by conv_id order by coalesce(h, m), k) nx from h) select conv_id, n, "start", coalesce(nx, size)::int "end", speaker, found from r where coalesce(nx, size) > "start" """
)
def anchored_turns(spark, d):
    """Ranges of tokens of each conversation's turns, found by their first words from a marker that lags behind, or by the marker."""
    text = transcripts(spark, d).select("conv_id", tn.tokens(F.col("text")).alias("tokens"))
    t = turns(spark, d).withColumn("ws", tn.tokens(F.col("words")))
    before = Window.partitionBy("conv_id").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("s", F.coalesce(F.sum(F.size("ws") + 1).over(before), F.lit(0)))
    t = t.select("conv_id", F.col("k").alias("n"), (F.col("s") - (F.col("conv_id") + F.col("k")) % 45).alias("marker"), F.array_join(F.slice("ws", 1, 6), " ").alias("first_words"), F.col("role").alias("speaker"))
    return tn.anchored_turns(text, t, "conv_id")


QUOTE_WORD = r"trim(regexp_replace(lower(replace(replace({t}, chr(8217), chr(39)), chr(8216), chr(39))), '[^\pL\pM\pN_'']', '', 'g'), '''')"


@query(
    f"""with d as (select doc_id, {SPLIT.format(t='text')} toks from documents), q as (select doc_id, toks, case when len(toks) >= 12 then list_transform(toks[4:11], lambda y, i: case when i = 4 and doc_id % 3 = 0 then '[SUBJECT]' when i = 5 and doc_id % 3 = 1 then '[AFFILIATION]' else y end) else toks end qt from d),
 n as (select doc_id, list_filter(list_transform(toks, lambda y, i: {{'w': {QUOTE_WORD.format(t='y')}, 'i': i - 1}}), lambda z: z.w <> '') t, list_filter(list_transform(qt, lambda y: case when y in ('[SUBJECT]', '[AFFILIATION]') then y else {QUOTE_WORD.format(t='y')} end), lambda z: z <> '') q from q),
 m as (select doc_id, t, list_transform(t, lambda z: z.w) w, q, coalesce(list_position(q, '[SUBJECT]'), list_position(q, '[AFFILIATION]'), 0) p, case when list_contains(q, '[AFFILIATION]') then 5 else 3 end most from n where len(q) >= 4),
 f as (select doc_id, t, q, p, case when p = 0 then list_transform(list_filter(range(0, len(w) - len(q) + 1), lambda i: w[i + 1 : i + len(q)] = q), lambda i: {{'i': i, 'n': 0}})
 else list_filter(flatten(list_transform(list_filter(range(0, len(w)), lambda i: w[i + 1 : i + p - 1] = q[1 : p - 1]), lambda i: list_transform(range(1, most + 1), lambda k: {{'i': i, 'n': k}}))), lambda z: z.i + p - 1 + z.n <= len(w) and w[z.i + p + z.n : z.i + z.n + len(q) - 1] = q[p + 1 : len(q)]) end c from m)
 select n.doc_id, t2.first, t2.last from n left join (select doc_id, t[c[1].i + 1].i::int first, t[c[1].i + len(q) + case when p = 0 then 0 else c[1].n - 1 end].i::int as "last" from f where len(c) > 0) t2 on t2.doc_id = n.doc_id"""
)
def token_quotes(spark, d):
    """Where a quote of eight words from the front of each document, one of them blinded in two of three, stands among its tokens."""
    docs = read(spark, d, "documents").withColumn("toks", tn.tokens(F.coalesce("text", F.lit(""))))
    k = F.col("doc_id") % 3
    blinded = F.transform(F.slice("toks", 4, 8), lambda y, i: F.when((i == 3) & (k == 0), "[SUBJECT]").when((i == 4) & (k == 1), "[AFFILIATION]").otherwise(y))
    quote = F.array_join(F.when(F.size("toks") >= 12, blinded).otherwise(F.col("toks")), " ")
    return docs.select("doc_id", F.explode(F.array(tn.quote_span(F.col("text"), quote))).alias("s")).select("doc_id", "s.first", "s.last")
