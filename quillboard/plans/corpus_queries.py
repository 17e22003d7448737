"""Queries of the corpus: records as JSON, manifests, captions, copies, replays and arrivals."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from quillboard.functions import text as tx
from quillboard.operators import corpus as co, replays as rp, grounding as gr, rater as rt, screens as sc, selection as se, transcript as tr
from quillboard.operators.rater import r6
from quillboard.plans.grounding_queries import Q, T, W, _located
from quillboard.plans.oracles import BOARD, F as FC, G, TOK
from quillboard.plans.registry import query
from quillboard.sources import records as js
from quillboard.sources.shared import shared_folder
from quillboard.sources.tables import first_ratings, forecasts, ratings, read, turns


@query(
    f"with {G} select judge, count(*) n, count(*) filter (rec % 11 = 0) excluded, count(distinct rec) recordings, round(avg(d1), 6) mean from g where rec % 13 <> 0 group by judge"
)
def grade_scan(spark, d):
    """Grades written as JSON by judge and read again: some have no grade, some are invalid, an obsolete copy is no data."""
    root = shared_folder(spark, "grades")
    rows = ratings(spark, d).select("judge", "rec", "mode", "run", F.when(F.col("rec") % 13 != 0, F.struct("d1", "d2", "d3")).alias("grade"), F.when(F.col("rec") % 11 == 0, F.array(F.lit("coverage"))).otherwise(F.array().cast("array<string>")).alias("validation_errors"))
    rows.withColumn("folder", F.concat(F.lit("j"), "judge")).write.partitionBy("folder").json(root)
    rows.where("rec % 3 = 0").write.json(f"{root}/_obsolete")
    back = js.read_grades(spark, root, "judge string, rec long, mode string, run int, grade struct<d1: double, d2: double, d3: double>, validation_errors array<string>")
    return back.groupBy("judge").agg(F.count("*").alias("n"), F.count_if("excluded").alias("excluded"), F.count_distinct("rec").alias("recordings"), r6(F.avg("grade.d1")).alias("mean"))


@query(
    "with h as (select sha256(doc_id::varchar || ' ' || sha256(text)) h from documents), p as (select substr(h, 1, 2) b, sha256(string_agg(h, chr(10) order by h)) d, count(*) n from h group by 1) select sum(n)::bigint as rows, sha256(string_agg(b || ' ' || d, chr(10) order by b || ' ' || d)) digest from p"
)
def corpus_digest(spark, d):
    return js.corpus_digest(read(spark, d, "documents"), F.concat(F.col("doc_id").cast("string"), F.lit(" "), F.sha2("text", 256)))


@query("select source slug, count(*) n, min(doc_id) as first, max(doc_id) as last, sum(length(text))::bigint chars from documents where doc_id % 17 <> 0 and doc_id % 7 <> 0 and source <> '' group by source")
def transcript_scan(spark, d):
    """Transcripts from JSON lines, without broken ones and those that lack a person or a text; other line ends than line feeds stay in the text."""
    root = shared_folder(spark, "transcripts")
    docs = read(spark, d, "documents")
    line = F.to_json(F.struct(F.col("source").alias("slug"), "doc_id", F.when(F.col("doc_id") % 7 != 0, F.col("text")).alias("text")))
    docs.select(F.when(F.col("doc_id") % 17 == 0, F.substring(line, 1, 20)).otherwise(line).alias("value")).write.text(root, lineSep="\n")
    back = js.read_transcripts(spark, root, "slug string, doc_id long, text string")
    return back.groupBy("slug").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.sum(F.length("text")).alias("chars"))


@query("select conv_id, count(*) n, sum(length(text) + 3)::bigint chars from conversations group by conv_id")
def record_lines(spark, d):
    """Records written as lines in order and parsed strictly; separators of lines and paragraphs inside them end none."""
    root = shared_folder(spark, "lines")
    js.write_lines(read(spark, d, "conversations").select("conv_id", "turn", "role", F.concat("text", F.lit("\u2028\u0085\r")).alias("text")), "conv_id", ["turn"], root)
    back = js.read_json(spark, root, "conv_id long, role string, text string, turn long", strict=True)
    return back.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


@query(
    """with s as (select 's' || l_suppkey::varchar slug, l_suppkey place, 'src' || (l_partkey % 40)::varchar source_id, case when l_orderkey % 9 = 0 then 'short' else substr(md5((l_partkey % 700)::varchar), 1, 11) end video_id, case when l_linenumber < 5 then l_linenumber end as rank, case when l_orderkey % 4 <> 0 then year(l_shipdate) end as year from lineitem),
 g as (select *, min(place) over (partition by video_id) first_ from s where length(video_id) = 11), k as (select * from g where place = first_)
 select slug, case when count(*) over (partition by slug, source_id) > 1 then source_id || '-' || substr(video_id, 1, 6) else source_id end source_id, video_id, coalesce(rank, 999) as rank, coalesce(year, 0) as year from k"""
)
def source_manifest(spark, d):
    line = read(spark, d, "lineitem")
    video = F.when(F.col("l_orderkey") % 9 == 0, "short").otherwise(F.substring(F.md5((F.col("l_partkey") % 700).cast("string")), 1, 11))
    s = line.select(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("slug"), F.col("l_suppkey").alias("place"), F.concat(F.lit("src"), (F.col("l_partkey") % 40).cast("string")).alias("source_id"), video.alias("video_id"), F.when(F.col("l_linenumber") < 5, F.col("l_linenumber")).alias("rank"), F.when(F.col("l_orderkey") % 4 != 0, F.year("l_shipdate")).alias("year"))
    return co.manifest(s)


@query(
    """with c as (select conv_id, list({'s': (turn * 23 + length(text) % 7)::double, 't': trim(regexp_replace(text, '\\s+', ' ', 'g'))} order by turn * 23 + length(text) % 7, trim(regexp_replace(text, '\\s+', ' ', 'g'))) c from conversations where trim(text) <> '' group by conv_id),
 m as (select conv_id, list_reduce(list_prepend({'n': 0.0::double, 'm': []::double[]}, list_transform(c, lambda x: {'n': x.s, 'm': []::double[]})), lambda a, x: case when x.n >= a.n then {'n': x.n + 60, 'm': list_append(a.m, x.n)} else a end) r, len(c) cues from c)
 select conv_id, cues::bigint cues, len(r.m)::int marks, array_to_string(list_transform(r.m, lambda x: x::bigint), ',') at_ from m"""
)
def caption_marks(spark, d):
    """Each conversation as captions: marks where a minute or more has gone by since the last."""
    cues = read(spark, d, "conversations").select("conv_id", (F.col("turn") * 23 + F.length("text") % 7).cast("double").alias("start"), "text")
    n = cues.where(F.trim("text") != "").groupBy("conv_id").agg(F.count("*").alias("cues"))
    return co.captions(cues, "conv_id").join(n, "conv_id").select("conv_id", "cues", F.size("marks").alias("marks"), F.array_join(F.transform("marks", lambda x: x.cast("long").cast("string")), ",").alias("at_"))


QUAL = r"""q as (select d.doc_id, d.source, coalesce(l.quality, 0) manual, len(regexp_extract_all(d.text, '\[[0-9:]+\]')) marks, len(t.w) words, t.w from documents d join t on t.doc_id = d.doc_id left join labels l on l.doc_id = d.doc_id),
 sh as (select doc_id, source, list_distinct([array_to_string(w[i : i + 4], ' ') for i in range(1, len(w) - 3)]) g from q where len(w) >= 5), ex as (select doc_id, source, len(g) n, unnest(g) h from sh)"""


def _copies(spark, d):
    docs = read(spark, d, "documents").join(read(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    w = tx.tokens(F.col("text"))
    return docs.select("doc_id", "source", F.coalesce("quality", F.lit(0)).alias("manual"), F.regexp_count("text", F.lit(r"\[[0-9:]+\]")).cast("long").alias("marks"), F.size(w).cast("long").alias("words"), "text")


@query(
    f"""with {TOK}, {QUAL}, p as (select a.doc_id n, b.doc_id k, count(*) / least(any_value(a.n), any_value(b.n)) c from ex a join ex b on a.source = b.source and a.h = b.h and a.doc_id % 2 = 1 and b.doc_id % 2 = 0 group by all),
 b as (select n, arg_max(k, (c, -k)) k, max(c) c from p where c >= 0.15 group by n), r as (select q.doc_id, b.k, coalesce(b.c, 0.0) c, (q.manual, q.marks, q.words) > (o.manual, o.marks, o.words) better from q left join b on b.n = q.doc_id left join q o on o.doc_id = b.k where q.doc_id % 2 = 1)
 select doc_id as "new", k known, round(c, 3) containment, case when c >= 0.4 then 'duplicate' when c >= 0.15 then 'review' else 'new' end verdict, case when c < 0.15 then 'merge' when c >= 0.4 and better then 'replace_existing' else 'drop' end action from r"""
)
def copy_decisions(spark, d):
    """New documents (odd ids) against known ones of their source: duplicates, the grey band, and what is new."""
    rows = _copies(spark, d)
    pairs = tr.shared_shingles(rows.where("doc_id % 2 = 1"), rows.where("doc_id % 2 = 0"), "doc_id", "source", tx.tokens(F.col("text")), co.DISTINCT)
    side = lambda c: rows.where(c).select(F.col("doc_id").alias("id"), "manual", "marks", "words")
    return co.decisions(pairs, side("doc_id % 2 = 1"), side("doc_id % 2 = 0"))


@query(None)
def copy_sweep(spark, d):
    """Of copies of one source's documents, equal ones too, the best stays, held against better ones that stay."""
    rows = _copies(spark, d)
    folder = shared_folder(spark, "sweep")

    def write(name, df):
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    texts, pairs = tr.copy_sets(read(spark, d, "documents"), "doc_id", "source", tx.tokens(F.col("text")), least=co.DUPLICATE)
    placed = se.by_quality(rows.select("doc_id", "source", "manual", "marks", "words"), ["source"], "doc_id").select(F.col("doc_id").alias("id"), F.col("k").alias("place"))
    return co.swept_copies(placed, texts.select(F.col("key").alias("id"), "set"), pairs, write).withColumnRenamed("id", "doc_id")


@query(
    r"""with t as (select doc_id, coalesce(text, '') text, list_filter(string_split_regex(coalesce(text, ''), '\s+'), lambda x: x <> '') toks from documents), d as (select *, list_filter(toks, lambda x: not regexp_full_match(x, '\[\d\d:\d\d:\d\d\]')) w from t),
 x as (select doc_id, i, md5(array_to_string(w[i + 1 : i + 20], ' ')) h from (select doc_id, w, unnest(range(0, len(w) - 19)) i from d)), m0 as (select doc_id, i, min(i) over (partition by doc_id, h) p from x), m as (select *, lag(i) over (partition by doc_id order by i) before_ from m0 where i > p),
 s0 as (select m.*, before_ is null or i - before_ > 20 seed, least(20, p, case when before_ is null then i else i - before_ - 20 end) most from m), e as (select s0.*, case when seed and most > 0 then list_transform(range(1, most + 1), lambda b: w[i - b + 1] = w[p - b + 1]) else [] end eq from s0 join d using (doc_id)),
 g as (select doc_id, i, seed, coalesce(list_max(list_filter(range(1, len(eq) + 1), lambda b: eq[b] and len(list_filter(range(4, b + 1), lambda z: not list_contains(eq[z - 3 : z], true))) = 0)), 0) back from e),
 n as (select doc_id, i - back s, i + 20 e, sum(case when seed and i - back > coalesce(lag_e, -1) then 1 else 0 end) over (partition by doc_id order by i) run from (select *, lag(i + 20) over (partition by doc_id order by i) lag_e from g)),
 r as (select doc_id, run, min(s) s, max(e) e from n group by doc_id, run), c as (select doc_id, sum(e - s) covered from r group by doc_id),
 j as (select doc_id, s, e, sum(case when before_ is null or s - before_ >= 20 then 1 else 0 end) over (partition by doc_id order by s) piece from (select *, lag(e) over (partition by doc_id order by s) before_ from r)), k as (select j.doc_id, min(s) s, max(e) e from j join c on c.doc_id = j.doc_id join d on d.doc_id = j.doc_id where covered / len(w) >= 0.05 group by j.doc_id, piece),
 tk as (select doc_id, z, tok, regexp_full_match(tok, '\[\d\d:\d\d:\d\d\]') stamp from (select doc_id, unnest(toks) tok, unnest(range(0, len(toks))) z from d where doc_id in (select doc_id from k))), tp as (select *, sum((not stamp)::int) over (partition by doc_id order by z) - 1 place from tk),
 kt as (select * from tp where stamp or not exists (select 1 from k where k.doc_id = tp.doc_id and s <= place and place < e)), ks as (select *, lead(stamp) over (partition by doc_id order by z) next_ from kt), lf as (select doc_id, string_agg(tok, ' ' order by z) left_ from ks where not stamp or not coalesce(next_, false) group by doc_id)
 select d.doc_id, len(w)::bigint words, coalesce((20000 * covered + len(w)) // (2 * len(w)) / 10000, 0) "share", coalesce((select sum(e - s) from k where k.doc_id = d.doc_id), 0)::bigint removed, md5(case when d.doc_id in (select doc_id from k) then coalesce(left_, '') else text end) text_md5 from d left join c on c.doc_id = d.doc_id left join lf on lf.doc_id = d.doc_id"""
)
def replay_cut(spark, d):
    """Texts without replayed passages: what goes and the digest of what stays."""
    cut = rp.without_replays(read(spark, d, "documents"), "doc_id", "text")
    return cut.select("doc_id", "words", "share", "removed", F.md5("text").alias("text_md5"))


@query(
    f"""with {FC}, s as (select id, case when id % 5 <> 0 then ts end arrived, case when id % 25 <> 0 then ts - interval 1 day end fetched, kind in ('purchase', 'view') seen from f) select case when seen then 'covered' when coalesce(arrived, fetched) is null then 'undated' when coalesce(arrived, fetched) < timestamp '2024-01-20' then 'stale' else 'later' end state, count(*) n, min(coalesce(arrived, fetched)) as first from s group by 1"""
)
def arrival_states(spark, d):
    """Rows that a report covers, those that came after it, and those that it should have covered."""
    f = forecasts(spark, d)
    shelf = f.select("id", F.when(F.col("id") % 5 != 0, F.col("ts")).alias("arrived"), F.when(F.col("id") % 25 != 0, F.col("ts") - F.expr("interval 1 day")).alias("fetched"))
    s = co.arrival_states(shelf, f.where("kind in ('purchase', 'view')").select("id"), F.lit("2024-01-20 00:00:00").cast(dict(shelf.dtypes)["arrived"]))
    return s.groupBy("state").agg(F.count("*").alias("n"), F.min(F.coalesce("arrived", "fetched")).alias("first"))


@query(
    f"""with {T}, {W}, {Q}, c as (select v.conv_id, v.k, role, loc.start, loc.fin, loc.occ, substr(sha256(v.conv_id::varchar || chr(10) || array_to_string(q.qw, ' ')), 1, 16) pid from v join q on q.conv_id = v.conv_id and q.k = v.k join loc on loc.conv_id = v.conv_id and loc.k = v.k),
 g as (select *, row_number() over (partition by pid order by k) n from c where start is not null)
 select conv_id, k quote_id, pid prediction_id, to_json({{'prediction_id': pid, 'source': {{'quote_char_start': start, 'quote_char_end': fin::bigint, 'occurrences': occ}}, 'speaker': {{'slug': role}}, 'status': 'pending'}})::varchar record from g where n = 1"""
)
def grounded_records(spark, d):
    """Records made of the candidates whose quotes are found, each prediction once, as nested JSON."""
    quotes = turns(spark, d).select("conv_id", F.col("k").alias("quote_id"), "role", F.array_join(F.transform(F.slice(F.regexp_extract_all("words", F.lit(r"([\p{L}\p{N}]+)"), 1), 1, 6), F.lower), " ").alias("norm"))
    rows = _located(spark, d).where("start is not null").join(quotes, ["conv_id", "quote_id"])
    rows = rows.withColumn("pid", F.substring(F.sha2(F.concat(F.col("conv_id").cast("string"), F.lit("\n"), "norm"), 256), 1, 16))
    rows = rows.withColumn("n", F.row_number().over(Window.partitionBy("pid").orderBy("quote_id"))).where("n = 1")
    record = F.struct(F.col("pid").alias("prediction_id"), F.struct(F.col("start").alias("quote_char_start"), F.col("end").alias("quote_char_end"), "occurrences").alias("source"), F.struct(F.col("role").alias("slug")).alias("speaker"), F.lit("pending").alias("status"))
    return rows.select("conv_id", "quote_id", F.col("pid").alias("prediction_id"), F.to_json(record).alias("record"))


@query(
    f"""with {FC}, r as (select f.id, person, 'by ' || deadline::varchar criteria, kind, p from f), x as (select r.*, case when o_orderkey is not null and o_orderstatus <> 'F' then 'by ' || o_orderdate::date::varchar end nc, case o_orderstatus when 'F' then 'ok' when 'O' then 'refused' end st from r left join orders on o_orderkey = id)
 select id, coalesce(nc, criteria) criteria, case when nc is not null then criteria end original_criteria, coalesce(st, 'not_run') status, case when st = 'ok' then kind <> 'error' end qualifies, to_json({{'id': id, 'p': round(p, 4), 'status': coalesce(st, 'not_run')}})::varchar page from x"""
)
def overlaid_records(spark, d):
    """Records with repairs of their criteria laid over and verdicts applied, and the fields that a page shows."""
    f = forecasts(spark, d)
    rows = f.select("id", "person", F.concat(F.lit("by "), F.col("deadline").cast("string")).alias("criteria"), "kind", "p")
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus", F.to_date("o_orderdate").alias("day"))
    rows = co.repaired_criteria(rows, o.where("o_orderstatus <> 'F'").select("id", F.concat(F.lit("by "), F.col("day").cast("string")).alias("criteria")))
    verdicts = o.select("id", F.when(F.col("o_orderstatus") == "F", "ok").when(F.col("o_orderstatus") == "O", "refused").alias("st"))
    rows = rows.join(verdicts, "id", "left").withColumn("verification", F.struct(F.coalesce("st", F.lit("not_run")).alias("status"))).withColumn("verification", F.col("verification").withField("qualifies", F.when(F.col("st") == "ok", F.col("kind") != "error")))
    page = F.struct("id", F.round("p", 4).alias("p"), F.col("verification.status").alias("status"))
    return rows.select("id", "criteria", "original_criteria", "verification.status", "verification.qualifies", F.to_json(page).alias("page"))


@query(
    f"""with {T}, {W}, {Q}, x as (select conv_id, string_agg(mark || ' ' || words, chr(10) order by k) txt from v group by conv_id), r as (select loc.conv_id, loc.k, start s, fin::bigint e, length(txt) n, loc.k % 6 bad, loc.mark, len(regexp_extract_all(regexp_replace(substr(txt, start + 1, (fin - start)::bigint), '\\[\\d\\d:\\d\\d:\\d\\d\\]', ' ', 'g'), '\\S+')) wc from loc join x on x.conv_id = loc.conv_id where start is not null),
 i as (select unnest(list_filter([case when bad = 1 then 'quote_outside' end, case when bad = 2 then 'quote_word_count' end, case when bad = 3 then 'timestamp_mark' end, case when bad = 4 then 'probability' end, case when bad = 5 then 'agreement' end, case when wc not between 6 and 60 then 'quote_length' end], lambda z: z is not null)) invariant from r)
 select invariant, count(*) n from i group by invariant"""
)
def record_invariants(spark, d):
    """Invariants of records against their transcripts: offsets, counts, marks, confidence, agreement; five rows in six are broken on purpose."""
    from quillboard.sources.tables import transcripts

    rows = _located(spark, d).where("start is not null").join(transcripts(spark, d), "conv_id")
    bad = F.col("quote_id") % 6
    span = F.substring("text", F.col("start").cast("int") + 1, (F.col("end") - F.col("start")).cast("int"))
    stored = rows.withColumn("wc", gr.quote_words(span)).withColumn("s", F.when(bad == 1, F.length("text") + 1).otherwise(F.col("start"))).withColumn("stored_wc", F.col("wc") + F.when(bad == 2, 1).otherwise(0)).withColumn("stored_mark", F.when(bad == 3, "[99:00:00]").otherwise(F.col("mark")))
    stored = stored.withColumn("p", F.when(bad == 4, 0.5)).withColumn("ctype", F.lit("none")).withColumn("agreement", F.when(bad == 5, False).otherwise(True)).withColumn("both", F.lit(True))
    failed = sc.broken(
        ("quote_outside", (F.col("s") < 0) | (F.col("s") > F.length("text"))), ("quote_word_count", F.col("stored_wc") != F.col("wc")), ("timestamp_mark", F.col("stored_mark") != F.col("mark")), ("probability", F.col("p").isNotNull() & (F.col("ctype") != "explicit_probability")),
        ("agreement", F.col("agreement") != F.col("both")), ("quote_length", ~F.col("wc").between(6, 60)),
    )
    return stored.select(F.explode(failed).alias("invariant")).groupBy("invariant").agg(F.count("*").alias("n"))


@query(
    """with r as (select l_orderkey f, l_linenumber n, l_partkey pos, substr(md5((l_partkey % 1500)::varchar || ':' || (l_orderkey // 8)::varchar), 1, 8) id from lineitem), o as (select *, lag(pos) over (partition by f order by n, pos) before_ from r)
 select 'repeated_id' as invariant, count(*) n from (select id from r group by id having count(*) > 1) union all select 'unsorted_file', count(distinct f) from o where pos < before_ union all select 'repeated_line', count(*) from (select f, n from r group by all having count(*) > 1)"""
)
def tree_invariants(spark, d):
    """Invariants of all files of records together: ids once, lines in order, no line twice."""
    r = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("f"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("pos"), F.substring(F.md5(F.concat_ws(":", (F.col("l_partkey") % 1500).cast("string"), F.expr("l_orderkey div 8").cast("string"))), 1, 8).alias("id"))
    ids = r.groupBy("id").count().where("count > 1").agg(F.count("*").alias("n")).select(F.lit("repeated_id").alias("invariant"), "n")
    before = F.lag("pos").over(Window.partitionBy("f").orderBy("n", "pos"))
    files = r.withColumn("before", before).where("pos < before").agg(F.count_distinct("f").alias("n")).select(F.lit("unsorted_file").alias("invariant"), "n")
    lines = r.groupBy("f", "n").count().where("count > 1").agg(F.count("*").alias("n")).select(F.lit("repeated_line").alias("invariant"), "n")
    return ids.union(files).union(lines)


@query(
    f"""with recursive {BOARD[len("with "):]}, {"vt as (select rec, venue, count(*) votes from g where run = 0 group by all), vr as (select *, row_number() over (partition by rec order by votes desc, venue) k, max(votes) over (partition by rec) top from vt), ag as (select rec, max(case when k = 1 then venue end) venue from vr group by rec having count(*) filter (votes = top) = 1)"},
 rw as (select con.person, con.rec, ag.venue, con.overall v from con join ag on ag.rec = con.rec where mode = 'F'), big as (select venue from rw group by venue having count(*) >= 8), cl as (select person, r.venue, count(*) n, sum(v) s from rw r join big on big.venue = r.venue group by all),
 it as (select 0 i, person, venue, n, s, 0.0::double e from cl union all select i + 1, person, venue, n, s, e2 - avg(e2) over () * 0 from (select i, person, venue, n, s, sum(s - n * pm) over (partition by venue) / sum(n) over (partition by venue) e2 from (select *, sum(s - n * e) over (partition by person) / sum(n) over (partition by person) pm from it where i < 200))),
 ef as (select venue, any_value(e) e from it where i = 200 group by venue), fx as (select venue, round(e - (select avg(e) from ef), 3) effect from ef)
 select rw.rec, rw.person, rw.venue, round(rw.v, 6) overall, round(rw.v - coalesce(fx.effect, 0), 2) adjusted from rw left join fx on fx.venue = rw.venue"""
)
def venue_adjusted(spark, d):
    """Blinded recordings of an agreed venue with and without the venue's effect."""
    g = first_ratings(spark, d)
    rows = rt.consensus(rt.calibrated(g).where("mode = 'F'")).join(rt.venue_vote(g).where("agreed").select("rec", "venue"), "rec")
    effects = rt.venue_effects(rows, "overall").select("venue", "effect")
    return rows.join(effects, "venue", "left").select("rec", "person", "venue", r6(F.col("overall")).alias("overall"), F.round(F.col("overall") - F.coalesce("effect", F.lit(0.0)), 2).alias("adjusted"))  # a row for each venue
