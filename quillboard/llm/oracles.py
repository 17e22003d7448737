"""SQL of operators that another engine can express over whole tables."""

from __future__ import annotations

from quillboard.llm import divergence, jaccard, license, periodic, suffixdedup

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Smallest node reachable over links l(a, b), for nodes n(id).
REACH = """e as (select a, b from l union select b, a from l), r(id, to_) as (select id, id from n union select r.id, e.b from r join e on e.a = r.to_), c as (select id, min(to_) component_id from r group by id)"""

JACCARD = rf"""with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') w from documents),
 s as (select doc_id, case when len(w) >= {jaccard.WIDTH} then list_distinct([array_to_string(w[i : i + {jaccard.WIDTH - 1}], ' ') for i in range(1, len(w) - {jaccard.WIDTH - 2})]) when len(w) > 0 then [array_to_string(w, ' ')] else [] end s from w),
 x as (select doc_id, len(s) k, unnest(s) h from s), p as (select a.doc_id a, b.doc_id b, count(*) common, any_value(a.k) ka, any_value(b.k) kb from x a join x b on a.h = b.h and a.doc_id < b.doc_id group by 1, 2),
 l as (select a, b from p where 100 * common >= 75 * (ka + kb - common)), n as (select doc_id id from s), {REACH}
 select doc_id, len(s)::bigint n_shingles, component_id from s join c on c.id = s.doc_id"""

VECTORS = f"""with recursive v as (select vec_id, label, embedding::double[] x from embeddings), g as (select * from v where label is not null and x is not null and len(x) > 0 and len(list_filter(x, lambda y: y is null or not isfinite(y))) = 0 and len(list_filter(x, lambda y: y <> 0)) > 0),
 l as (select a.vec_id a, b.vec_id b from g a join g b on a.label = b.label and len(a.x) = len(b.x) and a.vec_id < b.vec_id where list_cosine_similarity(a.x, b.x) >= 0.98), n as (select vec_id id from v), {REACH}, d as (select a id, count(*) k from e group by a)
 select vec_id, coalesce(k, 0)::bigint n_links, component_id, vec_id = component_id kept from v join c on c.id = vec_id left join d on d.id = vec_id"""

MIXING = """with recursive c as (select coalesce(source, '') s, count(*) n from documents group by 1), t as (select sum(n) total, count(*) k, greatest(1000, 4 * count(*)) p from c), f as (select s, n, greatest(1, n * p // total) part, n * p / total share, p from c, t),
 g as (select *, row_number() over (order by part - share, s) r, p - sum(part) over () missing from f), w as (select s, (part + case when r <= greatest(0, missing) then 1 else 0 end)::bigint part, row_number() over (order by s) i from g), ws as (select list(part order by i) ws, sum(part)::bigint period from w),
 e(slot, done, pick, nth) as (select -1::bigint, list_transform(ws, lambda x: 0::bigint), 0::bigint, 0::bigint from ws
 union all select slot + 1, list_transform(done, lambda x, j: case when j = best.i then x + 1 else x end), best.i, done[best.i] from (select slot, done, list_min(list_filter(list_transform(ws, lambda x, j: case when done[j] * period < (slot + 2) * x then {'d': ((done[j] + 1) * period + x - 1) // x, 'i': j} end), lambda z: z is not null)) best, period from e, ws) where slot + 1 < period),
 q as (select doc_id, coalesce(source, '') s, source, md5(coalesce(doc_id::varchar, md5(coalesce(text, '')))) k1, md5(coalesce(text, '')) k2 from documents),
 o as (select *, row_number() over (partition by s order by substr(k1, 1, 2) || substr(k2, 1, 1), k1, k2) - 1 rank from q)
 select doc_id, source, rank // 8 block, rank % 8 place, (rank // 8) * period // part as release, ((rank // 8 + 1) * period + part - 1) // part deadline, (rank // 8) // part * period + e.slot slot from o join w on w.s = o.s cross join ws join e on e.pick = w.i and e.nth = (rank // 8) % part and e.slot >= 0"""

REPEATS = f"""with h as (select doc_id, hex(encode(coalesce(text, ''))) x, (length(hex(encode(coalesce(text, '')))) // 2)::bigint n from documents),
 s as (select doc_id, p, md5(substr(x, (2 * p + 1)::int, {2 * suffixdedup.LENGTH})) k from (select doc_id, x, unnest(range(0, n - {suffixdedup.LENGTH - 1})) p from h where n >= {suffixdedup.LENGTH})),
 a as (select doc_id, p, lag(p) over (partition by doc_id order by p) before_, lead(p) over (partition by doc_id order by p) after_ from (select doc_id, p from s qualify row_number() over (partition by k order by doc_id, p) > 1)),
 r as (select doc_id, p from_, p + {suffixdedup.LENGTH} e, sum(case when before_ is null or before_ + {suffixdedup.LENGTH} < p then 1 else 0 end) over (partition by doc_id order by p) run from a), b as (select doc_id, run, min(from_) s, max(e) e from r group by doc_id, run),
 g as (select h.doc_id, h.x, h.n, b.s, b.e, lag(b.e, 1, 0) over (partition by h.doc_id order by b.s) last_, row_number() over (partition by h.doc_id order by b.s desc) z, b.run from h left join b on b.doc_id = h.doc_id)
 select doc_id, any_value(n) n_bytes, coalesce(sum(e - s), 0)::bigint n_removed, count(s) n_spans, sha256(unhex(case when count(s) = 0 then any_value(x) else string_agg(substr(x, (2 * last_ + 1)::int, (2 * (s - last_))::int), '' order by s) || any_value(substr(x, (2 * e + 1)::int)) filter (z = 1) end)) kept_sha256 from g group by doc_id"""

WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
LICENSES = rf"""with tp(label, txt) as (values {", ".join(f"('{label}', '{text}')" for label, text in license.TEMPLATES)}), t0 as (select *, list_distinct(string_split(txt, ' ')) ws, len(string_split(txt, ' ')) n from tp),
 t as (select *, ceil({license.THRESHOLD} * len(ws) - 1e-9)::int need, case when len(ws) < {license.WHOLE_BELOW} then ws else list_filter(ws, lambda x: list_contains([{", ".join(f"'{n}'" for n in sorted(license.NAMES))}], x)) end told from t0),
 d as (select doc_id, coalesce(text, '') text, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') w from documents), ph(q, label) as (values {", ".join(f"(string_split('{p}', ' '), '{label}')" for p, label in license.PHRASES.items())}),
 b0 as (select doc_id, label, unnest(list_filter(range(1, len(w) - len(q) + 2), lambda i: w[i : i + len(q) - 1] = q)) i from d, ph where list_contains(w, q[1])), b as (select doc_id, count(*) n_base, min(i) - 1 first_word, max(i) - 1 last_word, list_sort(list(distinct label)) ls from b0 group by doc_id),
 ln as (select doc_id, list_distinct(regexp_extract_all(line, '{WORD}')) ws from (select doc_id, unnest(string_split(lower(text), chr(10))) line from d)), m1 as (select doc_id, label, len(list_intersect(ln.ws, t.ws)) / len(t.ws) c from ln, t where len(ln.ws) >= 4 and len(list_intersect(ln.ws, t.ws)) >= need and len(list_filter(told, lambda x: not list_contains(ln.ws, x))) = 0),
 pg as (select doc_id, regexp_extract_all(p, '{WORD}') w from (select doc_id, unnest(string_split_regex(lower(text), '\n\s*\n')) p from d where contains(text, chr(10))) where contains(trim(p, ' '), chr(10))),
 m2 as (select doc_id, label, 1.0::double c from pg, t where len(ws) < {license.WHOLE_BELOW} and contains(' ' || array_to_string(w, ' ') || ' ', ' ' || txt || ' ')),
 m3 as (select doc_id, label, need, len(ws) k, list_max(list_transform(list_filter(range(1, len(w) + 1), lambda i: list_contains(ws, w[i])), lambda i: case when len(list_filter(told, lambda x: not list_contains(w[i : i + n - 1], x))) = 0 then len(list_intersect(list_distinct(w[i : i + n - 1]), ws)) else 0 end)) s from pg, t where len(ws) >= {license.WHOLE_BELOW} and len(list_intersect(list_distinct(w), ws)) >= need),
 m as (select * from m1 union all select * from m2 union all select doc_id, label, s / k from m3 where s >= need), f as (select doc_id, list(distinct label) ls, max(c) c from m group by doc_id)
 select d.doc_id, len(w)::bigint n_words, coalesce(n_base, 0)::bigint n_base, first_word, last_word, coalesce(array_to_string(b.ls, ','), '') base_labels, array_to_string(list_sort(list_distinct(list_concat(coalesce(b.ls, []), coalesce(f.ls, [])))), ',') labels, case when n_base > 0 then 1.0 else coalesce(f.c, 0.0) end::double score from d left join b on b.doc_id = d.doc_id left join f on f.doc_id = d.doc_id"""

#: crc32 of a list of bytes b, by a table that its polynomial gives (column ct).
CRC_TABLE = """select list(c order by n) ct from (select n, list_reduce(list_prepend(n, range(0, 8)), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) c from (select unnest(range(0, 256)) n))"""


def crc(b: str) -> str:
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {b}), lambda c, x: xor(c >> 8, ct[(xor(c, x) & 255) + 1])), 4294967295)::bigint"


RUNS = rf"""with tb as ({CRC_TABLE}), d0 as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w0, {crc("list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)")} h from documents, tb),
 d1 as (select doc_id, w0, len(w0) n, h % 10 = 0 and len(w0) > 0 looped, case when len(w0) > 0 then (h // 10) % len(w0) end a, (h // 10) % 8 r from d0),
 d as (select doc_id, n, case when looped then list_transform(range(0, n), lambda i: w0[case when i < a then i else a + (i - a) % (1 + (n - a) // (3 + r)) end + 1]) else w0 end w from d1),
 x as (select doc_id, n, i, md5(array_to_string(w[i + 1 : i + 8], ' ')) k from (select doc_id, n, w, unnest(range(0, n - 7)) i from d)),
 pr as (select a.doc_id, a.i, b.i - a.i q, row_number() over (partition by a.doc_id, b.i - a.i order by a.i) z from x a join x b on a.doc_id = b.doc_id and a.k = b.k and b.i > a.i and 3 * (b.i - a.i) <= a.n),
 st as (select doc_id, q, min(i) s, max(i) - min(i) + 8 + q len from pr group by doc_id, q, i - z), r as (select doc_id, s, len, min(q) q from st where len >= greatest({periodic.LEAST}, {periodic.TIMES} * q) group by all),
 b as (select * from r qualify row_number() over (partition by doc_id order by len / q desc, s, q) = 1), t as (select doc_id, count(*) k, string_agg(s || ',' || len || ',' || q || chr(10), '' order by s, q) txt from r group by doc_id),
 gone as (select distinct doc_id, unnest(range(s + q, s + len)) i from r), ws as (select doc_id, unnest(w) word, unnest(range(0, n)) i from d), kept as (select doc_id, string_agg(word, ' ' order by i) txt from ws anti join gone using (doc_id, i) group by doc_id)
 select d.doc_id, coalesce(k, 0)::bigint n_runs, b.s "start", b.len "length", b.q period, 1000 * b.len // b.q exponent_milli, sha256(coalesce(t.txt, '')) runs_sha256, sha256(coalesce(kept.txt, '')) collapsed_sha256
 from d left join b using (doc_id) left join t using (doc_id) left join kept using (doc_id)"""

DIVERGENCE = rf"""with d as (select row_number() over () id, coalesce(text, '') text, coalesce(lang, '') lang, coalesce(source, '') source from documents),
 o as (select id, lang, source, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) t from d), kept as (select lang, t, count(*) cl from o group by lang, t having count(distinct id) >= 10),
 c as (select lang, source, t, count(*) n from o semi join kept using (lang, t) group by all), g as (select distinct lang, source from d), v as (select lang, count(*) v, sum(cl) nl from kept group by lang), ng as (select lang, source, sum(n) ng from c group by all),
 s as (select g.lang, g.source, kept.t, coalesce(n, 0) n, 1 + (1000000000::hugeint * (coalesce(n, 0) + 2)) // (coalesce(ng, 0) + 2 * v) p, 1 + (1000000000::hugeint * (cl + 2)) // (nl + 2 * v) q from g join kept on kept.lang = g.lang join v on v.lang = g.lang left join c on c.lang = g.lang and c.source = g.source and c.t = kept.t left join ng on ng.lang = g.lang and ng.source = g.source),
 pr as (select a.lang, a.source, b.source item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) x from s a join s b on a.lang = b.lang and a.t = b.t and a.source <> b.source group by all),
 f as (select a.lang, a.source, 'pair' part, b.source item, coalesce(x, 0)::bigint "value" from g a join g b on a.lang = b.lang and a.source <> b.source left join pr on pr.lang = a.lang and pr.source = a.source and pr.item = b.source union all select lang, source, 'term', t, ((p - q) * (p - q) // (p + q))::bigint from s where n > 0 and p > q)
 select *, (row_number() over (partition by lang, source, part order by "value" desc, item))::int rank from f qualify part = 'pair' or rank <= 10"""

SHARDS = rf"""with tb as ({CRC_TABLE}), x as (select doc_id, hex(encode(coalesce(text, ''))) x from documents), y as (select doc_id, (len(x) // 2 + 16)::bigint size, {crc("list_transform(regexp_extract_all(x, '..'), lambda y: ('0x' || y)::bigint)")} text_crc32 from x, tb),
 z as (select *, sum(size) over (order by doc_id) - size b, sum(size) over () total from y), s as (select *, ((2 * b + size) * 40 // (2 * total))::int shard from z)
 select doc_id, size, text_crc32, 'bytes' law, shard, row_number() over (partition by shard order by doc_id) - 1 slot, null::int grown_shard, b::bigint "before" from s"""

ORACLES = {"op2_jaccard": JACCARD, "op3_suffixdedup": REPEATS, "op4_embedding": VECTORS, "op7_mixing": MIXING, "op9_license": LICENSES, "op11_periodic": RUNS, "op12_divergence": DIVERGENCE, "op13_sharding": SHARDS}
