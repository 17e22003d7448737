"""Queries over records as raw JSON, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from quillboard.operators import jsonwalk as jw
from quillboard.plans.registry import query
from quillboard.sources.tables import read

#: The schema of a forecast's record; the texts break it in ways that the rows' ids say.
RECORD = {
    "type": "object",
    "required": ["id", "source", "p"],
    "additionalProperties": False,
    "properties": {
        "id": {"type": "integer", "minimum": 0},
        "p": {"type": "number", "minimum": 0, "maximum": 1},
        "source": {"$ref": "#/$defs/source"},
        "tags": {"type": "array", "items": {"type": "string", "maxLength": 4}},
        "scale": {"enum": ["points", "share", None]},
        "version": {"const": 2},
        "verdict": {"anyOf": [{"type": "null"}, {"$ref": "#/$defs/verdict"}]},
    },
    "$defs": {
        "source": {"type": "object", "required": ["kind"], "additionalProperties": False, "properties": {"kind": {"type": "string", "minLength": 5}, "props": {"type": "object", "properties": {"k": {"type": "integer", "maximum": 80}}}}},
        "verdict": {"type": "object", "required": ["by", "hit"], "properties": {"by": {"type": "string"}, "hit": {"type": "boolean"}}, "additionalProperties": False},
    },
}

#: Pieces of a record's text: (condition on the id, text of the piece, else).
TEXT_SQL = """'{' || case when event_id % 13 = 0 then '"id": "' || event_id || '"' else '"id": ' || event_id end || case when event_id % 11 = 0 then '' else ', "p": ' || printf('%.2f', event_id % 115 / 100.0) end || ', "source": {"kind": "' || event_type || '", "props": ' || props || case when event_id % 7 = 0 then ', "score": {"rank_of": [1, {"edge": null}]}' else '' end || '}, "tags": ["a", "'
 || repeat('b', (event_id % 6)::int) || '"], "scale": ' || case event_id % 5 when 0 then 'null' when 1 then '"share"' when 2 then '"points"' when 3 then '"none"' else 'false' end || ', "version": ' || case when event_id % 9 = 0 then 'true' else '2' end || ', "verdict": ' || case event_id % 4 when 0 then 'null' when 1 then '{"by": "x", "hit": true}' when 2 then '{"by": 3, "hit": true}' else '[]' end
 || case when event_id % 17 = 0 then '' else '}' end"""


def record_text() -> Column:
    i = F.col("event_id")
    lit, pick = F.lit, lambda c, *values: F.element_at(F.array(*map(F.lit, values)), (c + 1).cast("int"))
    return F.concat(
        lit("{"), F.when(i % 13 == 0, F.concat(lit('"id": "'), i, lit('"'))).otherwise(F.concat(lit('"id": '), i)), F.when(i % 11 == 0, "").otherwise(F.concat(lit(', "p": '), F.format_string("%.2f", i % 115 / 100.0))),
        lit(', "source": {"kind": "'), F.col("event_type"), lit('", "props": '), F.col("props"), F.when(i % 7 == 0, ', "score": {"rank_of": [1, {"edge": null}]}').otherwise(""), lit('}, "tags": ["a", "'), F.repeat(lit("b"), (i % 6).cast("int")),
        lit('"], "scale": '), pick(i % 5, "null", '"share"', '"points"', '"none"', "false"), lit(', "version": '), F.when(i % 9 == 0, "true").otherwise("2"), lit(', "verdict": '), pick(i % 4, "null", '{"by": "x", "hit": true}', '{"by": 3, "hit": true}', "[]"), F.when(i % 17 == 0, "").otherwise("}"),
    )


@query(
    """with e as (select event_id id, event_type kind, (props->>'$.k')::int k from events), x as (select id, case when id % 17 = 0 then ['$: json'] else list_sort(list_filter([case when id % 13 = 0 then '$.id: type' end, case when id % 11 = 0 then '$: missing required p' when id % 115 > 100 then '$.p: maximum' end, case when id % 7 = 0 then '$.source: unexpected property score' end,
 case when length(kind) < 5 then '$.source.kind: minLength' end, case when k > 80 then '$.source.props.k: maximum' end, case when id % 6 > 4 then '$.tags[1]: maxLength' end, case when id % 5 > 2 then '$.scale: enum' end, case when id % 9 = 0 then '$.version: const' end, case id % 4 when 2 then '$.verdict: anyOf; closest: $.verdict.by: type' when 3 then '$.verdict: anyOf; closest: $.verdict: type' end], lambda z: z is not null)) end p from e)
 select id, len(p) problems, array_to_string(p, '; ') told from x"""
)
def record_schema(spark, d):
    """Every problem of each record's raw text against the schema of records."""
    p = read(spark, d, "events").select(F.col("event_id").alias("id"), F.explode(F.array(jw.schema_problems(record_text(), RECORD))).alias("p"))
    return p.select("id", F.size("p").alias("problems"), F.array_join("p", "; ").alias("told"))


@query(
    f"""with t as (select event_id id, {TEXT_SQL} t from events), w as (select t.id, fullkey path_, key, lower(json_tree.type) kind from t, json_tree(t.t::json) where json_valid(t.t)), k as (select regexp_replace(path_, '\\[\\d+\\]', '[]', 'g') path_, kind from w where key is not null and not regexp_matches(key, '^\\d+$'))
 select replace(path_, '"', '') "path", case kind when 'varchar' then 'string' when 'ubigint' then 'integer' when 'bigint' then 'integer' when 'double' then 'number' else kind end kind, count(*) n, regexp_matches(lower(regexp_extract(path_, '[^.]+$')), '{"|".join(jw.JUDGING)}') judging from k group by all"""
)
def record_keys(spark, d):
    """All paths of keys of the records' raw texts with their kinds, and which of them read like a judgement."""
    walked = jw.walk_json(read(spark, d, "events").select(F.col("event_id").alias("id"), record_text().alias("t")), "id", "t")
    paths = walked.select(F.regexp_replace("path", r"\[\d+\]", "[]").alias("path"), "kind", "name")
    judged = jw.judging_keys(paths.select("path", "name").distinct()).select("path", F.lit(True).alias("j"))
    return paths.groupBy("path", "kind").agg(F.count("*").alias("n")).join(judged, "path", "left").select("path", "kind", "n", F.coalesce("j", F.lit(False)).alias("judging"))
