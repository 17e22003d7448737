"""Queries that choose, merge and compare sets of rows."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from quillboard.functions import text as tx
from quillboard.operators import rater as rt, selection as se
from quillboard.operators.rater import means_in_order, r6
from quillboard.plans.oracles import F as FC, G
from quillboard.plans.registry import query
from quillboard.sources.tables import forecasts, ratings, read


@query(
    r"""with q as (select d.doc_id, source, coalesce(quality, 0) manual, len(regexp_extract_all(text, '\[[0-9:]+\]')) marks, len(regexp_extract_all(lower(text), '[a-z'']+')) words from documents d left join labels l on l.doc_id = d.doc_id)
 select doc_id, source, manual, marks, words, row_number() over (partition by source order by manual desc, marks desc, words desc, doc_id) k from q"""
)
def quality_order(spark, d):
    """A source's documents from the best copy on."""
    docs = read(spark, d, "documents").join(read(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    rows = docs.select("doc_id", "source", F.coalesce("quality", F.lit(0)).alias("manual"), F.regexp_count("text", F.lit(r"\[[0-9:]+\]")).cast("long").alias("marks"), F.size(tx.tokens(F.col("text"))).cast("long").alias("words"))
    return se.by_quality(rows, ["source"], "doc_id")


@query("select doc_id, source from (select doc_id, source, row_number() over (partition by source order by doc_id::varchar) k from documents) where k <= 7")
def per_person_limit(spark, d):
    """The first seven documents of each source in the order of their names: a feature with a limit of its own."""
    return se.limited(read(spark, d, "documents").select("doc_id", "source"), "source", [F.col("doc_id").cast("string")], 7)


@query(
    f"with {G}, c as (select person, rec, count(distinct judge) have from g where run = 0 and mode = 'F' group by all), p as (select count(distinct judge) panel from g) select person, rec, have, panel, case when have = panel then 'complete' else 'partial' end state from c, p"
)
def panel_scan(spark, d):
    """Recordings that all judges, or some, have rated blinded."""
    g = ratings(spark, d)
    return se.panel_scan(g.where("run = 0 and mode = 'F'"), ["person", "rec"], g)


@query(
    f"""with {G}, c as (select person, rec, count(distinct judge) have from g where run = 0 and mode = 'F' and rec % 3 = 0 group by all), cs as (select * from c where have = 3), h as (select person, count(*) have from cs group by person),
 i as (select distinct p_brand person, p_partkey rec from part), o as (select i.person, i.rec, b.rec is not null begun, greatest(0, 20 - coalesce(h.have, 0)) need from i left join c b on b.person = i.person and b.rec = i.rec and b.have < 3 left join h on h.person = i.person where not exists (from cs where cs.person = i.person and cs.rec = i.rec)),
 k as (select *, row_number() over (partition by person order by case when begun then 0 else 1 end, md5(rec::varchar), rec) k, count(*) over (partition by person) open_ from o)
 select person, rec, k, begun, greatest(0, need - open_) short from k where k <= need"""
)
def top_up(spark, d):
    """Recordings that bring each person to twenty complete ones, begun ones first."""
    g = ratings(spark, d).where("run = 0 and mode = 'F' and rec % 3 = 0").groupBy("person", "rec").agg(F.count_distinct("judge").alias("have"))
    items = read(spark, d, "part").select(F.col("p_brand").alias("person"), F.col("p_partkey").alias("rec")).distinct()
    return se.top_up(items, g.where("have = 3"), g.where("have < 3"), "person", "rec", 20)


@query(
    """with e as (select *, row_number() over (partition by source, ext order by md5(doc_id::varchar), doc_id) k, count(*) filter (not ext) over (partition by source) own, count(*) filter (ext) over (partition by source) x from (select doc_id, source, lang <> 'en' ext from documents)),
 t as (select *, least(x, 5) first_ from e), f as (select *, least(own, 10 - first_) fill from t) select doc_id, source, ext, k from f where k <= case when ext then least(x, 10 - fill) else fill end"""
)
def pilot_sample(spark, d):
    """Ten documents of each source, half of them foreign where there are enough: a sampling operator."""
    rows = read(spark, d, "documents").select("doc_id", "source", (F.col("lang") != "en").alias("ext"))
    return se.half_sample(rows, "source", "doc_id", "ext", 10)


@query(
    r"""with q as (select conv_id, turn, role, lower(regexp_extract(text, '(\S+\s+){4,12}\S+')) quote from conversations), u as (select conv_id, turn, role, quote, md5(conv_id::varchar || ':' || turn::varchar || ':' || quote) h from q where quote <> '')
 select role, conv_id, turn, k from (select *, row_number() over (partition by role order by h, conv_id, turn) k from u) where k <= 40"""
)
def quote_kit(spark, d):
    """Forty quotes of each speaker in digest order: a sampling operator."""
    q = read(spark, d, "conversations").select("conv_id", "turn", "role", F.lower(F.regexp_extract("text", r"(\S+\s+){4,12}\S+", 0)).alias("quote")).where("quote <> ''")
    h = q.withColumn("h", F.md5(F.concat_ws(":", "conv_id", "turn", "quote")))
    return se.ranked(h, ["role"], [F.col("h"), F.col("conv_id"), F.col("turn")]).where("k <= 40").select("role", "conv_id", "turn", "k")


@query(
    f"""with {FC}, m as (select id, person, deadline, p, case kind when 'purchase' then 0 when 'view' then 1 else 2 end conf, kind, abs(deadline - date '2024-02-01') gap from f)
 select person, id, kind, deadline from (select *, row_number() over (partition by person order by conf, kind, gap, id) k from m) where k = 1"""
)
def primary_market(spark, d):
    """Of a person's markets the surest, then the first platform, then the nearest close, then the smallest id."""
    f = forecasts(spark, d).withColumn("conf", F.when(F.col("kind") == "purchase", 0).when(F.col("kind") == "view", 1).otherwise(2))
    order = F.struct("conf", "kind", F.abs(F.datediff("deadline", F.lit("2024-02-01").cast("date"))).alias("gap"), "id")
    return f.groupBy("person").agg(F.min_by(F.struct("id", "kind", "deadline"), order).alias("m")).select("person", "m.id", "m.kind", "m.deadline")


@query(
    f"""with {FC}, s as (select person, count(*) n, count(*) filter (deadline <= date '2024-02-15') due, round(avg(p), 6) mean_p from f group by person)
 select person, n, due, mean_p, row_number() over (order by (due = 0), mean_p desc, person) as place from s where n >= 4 and due >= 1"""
)
def person_rows(spark, d):
    """Persons of at least four forecasts, one of them due, in the order of the page."""
    s = means_in_order(forecasts(spark, d), "person", ["id", "ts", "p"], F.col("p"), n=F.count("*"), due=F.count_if(F.col("deadline") <= F.lit("2024-02-15").cast("date")))
    s = s.where("n >= 4 and due >= 1").select("person", "n", "due", F.col("mean").alias("mean_p"))
    return s.withColumn("place", F.row_number().over(Window.orderBy(F.col("due") == 0, F.desc("mean_p"), "person")))  # a row for each person


@query(
    f"""with {FC}, s as (select person, round(avg(p) filter (kind <> 'error'), 6) mean_p, count(*) filter (kind = 'purchase') hits from f group by person)
 select person, mean_p, hits, row_number() over (order by (hits = 0), case when hits > 0 then mean_p end desc, person) as place from s"""
)
def default_order(spark, d):
    """Scored persons from the best mean, then the others by name."""
    s = means_in_order(forecasts(spark, d), "person", ["id", "ts", "p"], F.when(F.col("kind") != "error", F.col("p")), hits=F.count_if(F.col("kind") == "purchase"))
    s = s.select("person", F.col("mean").alias("mean_p"), "hits")
    return s.withColumn("place", F.row_number().over(Window.orderBy(F.col("hits") == 0, F.when(F.col("hits") > 0, F.col("mean_p")).desc(), "person")))  # a row for each person


@query(f"with {G} select person, count(*) transcripts from (select person, rec from g where run = 0 group by all having count(distinct judge) = (select count(distinct judge) from g)) group by person")
def rated_by_all(spark, d):
    """Recordings that every judge has rated, per person."""
    g = ratings(spark, d)
    return se.panel_scan(g.where("run = 0"), ["person", "rec"], g).where("state = 'complete'").groupBy("person").agg(F.count("*").alias("transcripts"))


@query("select c_custkey, c_mktsegment, exists (from orders where o_custkey = c_custkey and o_orderpriority = '1-URGENT') on_board from customer where c_nationkey in (select n_nationkey from nation where n_regionkey < 3)")
def on_board(spark, d):
    """Customers of three regions (semi join), and whether they have an urgent order."""
    nations = read(spark, d, "nation").where("n_regionkey < 3")
    urgent = read(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("u", F.lit(True))
    c = read(spark, d, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
    return c.join(urgent, "c_custkey", "left").select("c_custkey", "c_mktsegment", F.coalesce("u", F.lit(False)).alias("on_board"))


@query("select c_custkey from customer where not exists (from orders where o_custkey = c_custkey and o_orderstatus = 'P')")
def unsearched(spark, d):
    """Customers without a pending order (anti join); one whose order is of nothing counts as searched."""
    return read(spark, d, "customer").select("c_custkey").join(read(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")


@query("select slug, array_to_string(list_sort(list(board)), ',') boards from (select p_brand slug, 'size' || (p_size % 3)::varchar board from part group by all) group by slug")
def membership(spark, d):
    """The boards of each person; an unknown or repeated board is an error."""
    rows = read(spark, d, "part").select(F.col("p_brand").alias("slug"), F.concat(F.lit("size"), (F.col("p_size") % 3).cast("string")).alias("board")).distinct()
    return se.board_membership(rows, ["size0", "size1", "size2"]).select("slug", F.array_join("boards", ",").alias("boards"))


@query(
    """with a as (select doc_id id, 'old' side from documents where doc_id % 3 <> 1), b as (select doc_id id, 'new' side from labels) select side, count(*) n, min(id) as first, max(id) as last from (select * from a union all select * from b where id not in (select id from a)) group by side"""
)
def pool_merge(spark, d):
    """A pool with what is new in another one; nothing known is lost."""
    old = read(spark, d, "documents").where("doc_id % 3 <> 1").select(F.col("doc_id").alias("id"), F.lit("old").alias("side"))
    new = read(spark, d, "labels").select(F.col("doc_id").alias("id"), F.lit("new").alias("side"))
    return se.merged_pool(old, new, "id").groupBy("side").agg(F.count("*").alias("n"), F.min("id").alias("first"), F.max("id").alias("last"))


@query("select coalesce(a.doc_id, b.doc_id) id, coalesce(a.quality, b.quality) quality from (select * from labels where doc_id % 2 = 0 or doc_id % 3 = 0) a full join (select * from labels where doc_id % 5 < 3) b on a.doc_id = b.doc_id")
def promoted(spark, d):
    """Two overlapping sets of labels put together; a conflict would stop the job."""
    a = read(spark, d, "labels").select(F.col("doc_id").alias("id"), "quality")
    return se.refuse_conflicts(a.where("id % 2 = 0 or id % 3 = 0"), a.where("id % 5 < 3"), "id", "quality")


@query(
    """with r as (select l_orderkey id, l_linenumber % 2 run, max(l_quantity) q from lineitem group by all), m as (select * from r where not (run = 0 and id % 3 = 0) and not (run = 1 and id % 3 = 1)), n as (select * from m where not (run = 0 and id % 3 = 2 and exists (from r x where x.id = m.id and x.run = 1)))
 select run, count(*) n, sum(q) total from n group by run"""
)
def runs_union(spark, d):
    """Results of two runs, keys in both settled by manifests of dropped and replaced rows; any other would stop the job."""
    r = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id"), (F.col("l_linenumber") % 2).alias("run")).agg(F.max("l_quantity").alias("q"))
    drop = r.where("(run = 0 and id % 3 = 0) or (run = 1 and id % 3 = 1)").select("id", "run")
    replace = r.where("id % 3 = 2").select("id", F.lit(0).alias("old"), F.lit(1).alias("new")).distinct()
    return se.across_runs(r, "id", drop, replace).groupBy("run").agg(F.count("*").alias("n"), F.sum("q").alias("total"))


@query(
    """with r as (select l_orderkey id, l_linenumber % 3 run, max(l_shipdate::date) as deadline from lineitem group by all) select id, count(*) runs, count(distinct deadline) windows, min(deadline) as first, count(distinct deadline) > 1 conflict from r group by id"""
)
def resolutions_across(spark, d):
    """One window for each key over all runs, and the keys whose runs judged different ones."""
    r = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id"), (F.col("l_linenumber") % 3).alias("run")).agg(F.max(F.to_date("l_shipdate")).alias("deadline"))
    return r.groupBy("id").agg(F.count("*").alias("runs"), F.count_distinct("deadline").alias("windows"), F.min("deadline").alias("first")).withColumn("conflict", F.col("windows") > 1)


@query(
    f"""with {FC}, a as (select id, kind, p a, least(0.99, greatest(0.01, p + ((id * 7919) % 21 - 10) / 100.0)) b from f)
 select coalesce(kind, 'all') kind, count(*) n, round(avg(b - a), 6) shift, round(stddev_samp(b - a), 6) sd, count(*) filter (b - a > 0.01) raised, count(*) filter (b - a < -0.01) lowered, count(*) filter (abs(b - a) <= 0.01) unchanged from a group by rollup (kind)"""
)
def prior_versions(spark, d):
    """Two versions of each prior: mean shift and how many rose, fell or stayed, by outcome and in all."""
    f = forecasts(spark, d)
    a = f.select("id", "kind", F.col("p").alias("a"))
    b = f.select("id", F.least(F.lit(0.99), F.greatest(F.lit(0.01), F.col("p") + ((F.col("id") * 7919) % 21 - 10) / 100.0)).alias("b"))
    x = F.col("b") - F.col("a")
    g = a.join(b, "id").rollup("kind")
    out = g.agg(F.count("*").alias("n"), r6(F.avg(x)).alias("shift"), r6(F.stddev_samp(x)).alias("sd"), F.count_if(x > 0.01).alias("raised"), F.count_if(x < -0.01).alias("lowered"), F.count_if(F.abs(x) <= 0.01).alias("unchanged"))
    return out.withColumn("kind", F.coalesce("kind", F.lit("all")))


@query(
    """with a as (select doc_id, quality, toxic, md5(doc_id::varchar || quality::varchar) why from labels), b as (select doc_id, case when doc_id % 6 = 0 then 1 - quality else quality end quality, why from a), m as (select a.doc_id, a.quality qa, b.quality qb from a join b on a.doc_id = b.doc_id and a.why = b.why),
 p as (select *, row_number() over (partition by qa order by sha256('pick:' || doc_id::varchar), doc_id) k from m) select qa, qb, count(*) n from p where k <= 30 group by all"""
)
def resolver_pairs(spark, d):
    """Thirty results of each outcome in digest order, two resolvers side by side: a sampling operator."""
    a = read(spark, d, "labels").select("doc_id", F.col("quality").alias("qa"), F.md5(F.concat(F.col("doc_id").cast("string"), F.col("quality").cast("string"))).alias("why"))
    b = a.select("doc_id", F.when(F.col("doc_id") % 6 == 0, 1 - F.col("qa")).otherwise(F.col("qa")).alias("qb"), "why")
    p = se.ranked(a.join(b, ["doc_id", "why"]), ["qa"], [F.sha2(F.concat(F.lit("pick:"), F.col("doc_id").cast("string")), 256), F.col("doc_id")])
    return p.where("k <= 30").groupBy("qa", "qb").agg(F.count("*").alias("n"))


@query("""select coalesce(a.quality::varchar, 'none') a, coalesce(b.toxic::varchar, 'none') b, count(*) n, count(*) filter (a.quality <> b.toxic) differ from (select * from labels where doc_id % 4 <> 0) a full join (select * from labels where doc_id % 4 <> 1) b on a.doc_id = b.doc_id group by 1, 2""")
def verifier_confusion(spark, d):
    """Two verifiers over the same candidates: every pair of verdicts, and what only one of them saw."""
    rows = read(spark, d, "labels")
    a, b = rows.where("doc_id % 4 <> 0").select("doc_id", F.col("quality").alias("x")), rows.where("doc_id % 4 <> 1").select("doc_id", F.col("toxic").alias("y"))
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none"))
    return a.join(b, "doc_id", "full").groupBy(name("x").alias("a"), name("y").alias("b")).agg(F.count("*").alias("n"), F.count_if(F.col("x") != F.col("y")).alias("differ"))


@query(
    f"""with {FC}, o as (select o_custkey person, max(o_orderdate::date) as upd from orders group by 1), j as (select f.*, upd from f left join o on o.person = f.person)
 select case when upd is null then 'none' when upd > date '1998-07-01' and said > date '2024-01-15' then 'superseded' when upd > date '1998-07-01' then 'override_stale' else 'row_stale' end state, count(*) n, count(distinct person) people from j group by 1"""
)
def override_supersede(spark, d):
    """Rows against the overrides of their person: superseded, or one of the two is stale."""
    o = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("person")).agg(F.max(F.to_date("o_orderdate")).alias("upd"))
    j = forecasts(spark, d).join(o, "person", "left")
    fresh = F.col("upd") > F.lit("1998-07-01").cast("date")
    state = F.when(F.col("upd").isNull(), "none").when(fresh & (F.col("said") > F.lit("2024-01-15").cast("date")), "superseded").when(fresh, "override_stale").otherwise("row_stale")
    return j.groupBy(state.alias("state")).agg(F.count("*").alias("n"), F.count_distinct("person").alias("people"))


@query(
    f"""with {FC}, s as (select o_orderkey id, '2024-02-01'::date + (o_orderkey % 9)::int as deadline, md5(o_orderkey::varchar || o_orderstatus) prompt from orders), j as (select f.id, f.deadline <> s.deadline moved, md5(f.id::varchar || case when f.kind = 'error' then 'F' else 'O' end) <> s.prompt changed from f join s on s.id = f.id)
 select case when moved then 'deadline_changed' when changed then 'prompt_changed' else 'current' end state, count(*) n from j group by 1"""
)
def stale_sidecars(spark, d):
    """Stored answers whose deadline is not the row's any more, or else whose prompt's digest has changed."""
    s = read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.date_add(F.lit("2024-02-01").cast("date"), (F.col("o_orderkey") % 9).cast("int")).alias("judged"), F.md5(F.concat(F.col("o_orderkey").cast("string"), "o_orderstatus")).alias("prompt"))
    j = forecasts(spark, d).join(s, "id")
    prompt = F.md5(F.concat(F.col("id").cast("string"), F.when(F.col("kind") == "error", "F").otherwise("O")))
    state = F.when(F.col("deadline") != F.col("judged"), "deadline_changed").when(prompt != F.col("prompt"), "prompt_changed").otherwise("current")
    return j.groupBy(state.alias("state")).agg(F.count("*").alias("n"))


@query(
    f"""with {FC}, m as (select user_id person, event_type kind, min(event_id) head from events group by all), c as (select f.id, m.head, f.deadline from f join m on m.person = f.person and m.kind = f.kind where f.id <> m.head)
 select c.head, count(*) members, min(c.deadline) first_deadline, count(*) filter (c.deadline > h.deadline) later from c join f h on h.id = c.head group by c.head"""
)
def restatement_clusters(spark, d):
    """Restatements by the claim that they restate, a person's first of its kind; a claim restates itself never."""
    f = forecasts(spark, d)
    heads = f.groupBy("person", "kind").agg(F.min_by(F.struct("id", "deadline"), "id").alias("h"))
    c = f.join(heads, ["person", "kind"]).where("id <> h.id")
    return c.groupBy(F.col("h.id").alias("head")).agg(F.count("*").alias("members"), F.min("deadline").alias("first_deadline"), F.count_if(F.col("deadline") > F.col("h.deadline")).alias("later"))


@query("select count(*) n, min(doc_id) as first, max(doc_id) as last from (select doc_id from labels where quality = 1 union select doc_id from documents where lang = 'en' except select doc_id from labels where toxic = 1)")
def verified_set(spark, d):
    """The union of two sets of keys without those withdrawn."""
    labels = read(spark, d, "labels")
    u = labels.where("quality = 1").select("doc_id").union(read(spark, d, "documents").where("lang = 'en'").select("doc_id")).distinct()
    return u.join(labels.where("toxic = 1").select("doc_id"), "doc_id", "left_anti").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))


@query(
    """with a as (select p_brand slug, list_sort(list(distinct lower(split_part(p_name, ' ', 1)))) derived, list_sort(list(distinct lower(split_part(p_type, ' ', 1)))) known from part group by 1)
 select slug, array_to_string(list_sort(list_distinct(list_concat(known, derived))), ',') aliases, array_to_string(list_sort(list_filter(derived, lambda x: length(x) < 5 and not list_contains(known, x))), ',') short from a"""
)
def merged_aliases(spark, d):
    """Aliases that a person's names give together with those known, and the short ones reported."""
    first = lambda c: F.array_sort(F.collect_set(F.lower(F.split_part(F.col(c), F.lit(" "), F.lit(1)))))
    a = read(spark, d, "part").groupBy(F.col("p_brand").alias("slug")).agg(first("p_name").alias("derived"), first("p_type").alias("known"))
    short = F.filter(F.array_except("derived", "known"), lambda x: F.length(x) < 5)
    return a.select("slug", F.array_join(F.array_sort(F.array_union("known", "derived")), ",").alias("aliases"), F.array_join(F.array_sort(short), ",").alias("short"))


@query(
    f"""with {G}, r as (select distinct p_brand person from part), i as (select p_brand person, count(*) identified from part group by 1), ft as (select person, count(distinct rec) fetched from g group by 1), gt as (select person, count(distinct rec) gated from g where share >= 5 group by 1),
 gr as (select person, count(*) graded from (select person, rec from g where run = 0 and mode = 'F' group by all having count(distinct judge) = (select count(distinct judge) from g)) group by 1), c as (select person, count(*) calls, round(avg(d1), 6) score from g group by 1)
 select r.person, coalesce(identified, 0) identified, coalesce(fetched, 0) fetched, coalesce(gated, 0) gated, coalesce(graded, 0) graded, coalesce(calls, 0) calls, score from r left join i on i.person = r.person left join ft on ft.person = r.person left join gt on gt.person = r.person left join gr on gr.person = r.person left join c on c.person = r.person"""
)
def coverage_table(spark, d):
    """Each roster person's counts at every stage, recordings of the last one rated by all judges."""
    g, part = ratings(spark, d), read(spark, d, "part")
    per = g.groupBy("person", "rec").agg(F.max("share").alias("share"), F.count("*").alias("calls"), F.sum("d1").alias("s"), F.count_distinct(F.when((F.col("run") == 0) & (F.col("mode") == "F"), F.col("judge"))).alias("judges"))
    per = per.crossJoin(F.broadcast(g.agg(F.count_distinct("judge").alias("panel"))))  # one row
    stages = per.groupBy("person").agg(F.count("*").alias("fetched"), F.count_if(F.col("share") >= 5).alias("gated"), F.count_if(F.col("judges") == F.col("panel")).alias("graded"), F.sum("calls").alias("calls"), F.sum("s").alias("s"))
    roster = part.groupBy(F.col("p_brand").alias("person")).agg(F.count("*").alias("identified"))
    out = roster.join(stages, "person", "left").fillna(0, ["fetched", "gated", "graded", "calls"])
    return out.select("person", "identified", "fetched", "gated", "graded", "calls", r6(F.col("s") / F.nullif("calls", F.lit(0))).alias("score"))
