"""Raw JSON as VARIANT values: all its keys by path, and rules of a JSON Schema.

Nothing of a record is lost to a fixed schema: unknown keys are there to be refused. A walk or
a validation is one projection of a row, however nested the record; schemas are compiled into
column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quillboard.functions.dategrammar import let

#: Words in a key that read like a judgement, and keywords that are understood.
JUDGING = ("accuracy", "accurate", "score", "rank", "resolved", "correct", "brier", "edge", "skill")
KEYWORDS = {"$schema", "title", "description", "type", "const", "enum", "required", "properties", "additionalProperties", "items", "minimum", "maximum", "minLength", "maxLength", "anyOf", "$defs", "$ref"}
TYPES = {"object", "array", "string", "boolean", "null", "number", "integer"}
NODE = "array<struct<path: string, key: string, value: variant>>"


def kind(v: Column) -> Column:
    """object, array, string, boolean, null, integer or number: the JSON type of a VARIANT."""
    s = F.schema_of_variant(v)
    out = F.when(s.startswith("OBJECT"), "object").when(s.startswith("ARRAY"), "array").when(s == "STRING", "string").when(s == "BOOLEAN", "boolean").when(s == "VOID", "null")
    return out.when(s.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "integer").otherwise("number")


def _entries(v: Column) -> Column:
    return F.map_entries(v.cast("map<string, variant>"))


def _children(node: Column) -> Column:
    """The nodes right below a node."""

    def of(k: Column) -> Column:
        named = F.transform(_entries(node["value"]), lambda e: F.struct(F.concat(node["path"], F.lit("."), e["key"]).alias("path"), e["key"].alias("key"), e["value"].alias("value")))
        listed = F.transform(node["value"].cast("array<variant>"), lambda x, i: F.struct(F.concat(node["path"], F.lit("["), i.cast("string"), F.lit("]")).alias("path"), F.lit(None).cast("string").alias("key"), x.alias("value")))
        return F.when(k == "object", named).when(k == "array", listed).otherwise(F.array().cast(NODE))

    return let(kind(node["value"]), of)


def walk_json(rows: DataFrame, key: str, text: str, levels: int = 12) -> DataFrame:
    """key, path, name, kind of every key of a JSON text, nested ones and those in lists too.

    ``$.a.b[0].c`` is the path of c in the first item of b in a. Null texts and texts that are no JSON have no
    keys. A record nested deeper than ``levels`` stops the job.
    """
    rows = rows.select(key, F.try_parse_json(text).alias("v")).where("v is not null")
    top = F.array(F.struct(F.lit("$").alias("path"), F.lit(None).cast("string").alias("key"), F.col("v").alias("value")))
    rows = rows.select(key, top.alias("level0"))
    for k in range(levels + 1):
        rows = rows.withColumn(f"level{k + 1}", F.flatten(F.transform(f"level{k}", _children)))
    deep = F.when(F.size(f"level{levels + 1}") > 0, F.raise_error(F.lit(f"a record is nested deeper than {levels} levels")).cast(NODE)).otherwise(F.array().cast(NODE))
    every = F.concat(*[F.col(f"level{k}") for k in range(1, levels + 1)], deep)
    nodes = rows.select(key, F.explode(every).alias("n"))
    return nodes.where("n.key is not null").select(key, "n.path", F.col("n.key").alias("name"), kind(F.col("n.value")).alias("kind"))


def judging_keys(walked: DataFrame, words: tuple[str, ...] = JUDGING) -> DataFrame:
    """The walked keys whose name holds a word that judges."""
    return walked.where("|".join(f"lower(name) like '%{w}%'" for w in words).replace("|", " or "))


def _known(schema: dict, root: dict) -> dict:
    """The schema behind its references; an unsupported keyword or reference is an error, not silence."""
    followed = set()
    while "$ref" in schema:
        ref = schema["$ref"]
        if ref in followed:
            raise ValueError(f"unsupported $ref {ref}: it leads to itself")
        followed.add(ref)
        if not ref.startswith("#/$defs/") or ref[8:] not in root.get("$defs", {}):
            raise ValueError(f"unsupported $ref {ref}")
        schema = root["$defs"][ref[8:]]
    unknown = set(schema) - KEYWORDS
    types = schema.get("type", [])
    unknown |= set([types] if isinstance(types, str) else types) - TYPES
    if unknown or schema.get("additionalProperties", False) not in (False, True):
        raise ValueError(f"unsupported keywords {sorted(unknown) or ['additionalProperties']}")
    return schema


def schema_problems(text: Column, schema: dict, levels: int = 12) -> Column:
    """What is wrong with a JSON text, sorted: "path: rule" for each rule that fails; null for a null text.

    Understood are type (also lists of types), const, enum, required, properties,
    additionalProperties (false), items, minimum, maximum, minLength, maxLength, anyOf and $ref to
    #/$defs/name; anything else in the schema stops at once. A value that misses its const, enum
    or type is not looked at further. Of an anyOf that no branch meets, the first problem of the
    branch that got deepest is told. A schema that refers to itself is followed ``levels`` deep,
    deeper values stop the job. A text that is no JSON has the problem "$: json".
    """
    parsed = let(F.try_parse_json(text), lambda v: F.when(v.isNull(), F.array(F.lit("$: json"))).otherwise(_problems(v, schema, F.lit("$"), schema, levels)))
    return F.when(text.isNotNull(), F.array_sort(parsed))


def _problems(v: Column, schema: dict, path: Column, root: dict, levels: int) -> Column:
    schema = _known(schema, root)
    none, say = F.array().cast("array<string>"), lambda rule: F.concat(path, F.lit(f": {rule}"))
    if levels < 0:
        return F.when(v.isNotNull(), F.raise_error(F.lit("a record is nested deeper than its schema is followed")).cast("array<string>")).otherwise(none)

    def literal(x) -> Column:
        """Whether the value is that of the schema; true is not 1."""
        if x is None or isinstance(x, bool):
            return F.to_json(v) == F.lit("null" if x is None else str(x).lower())
        if isinstance(x, (int, float)):
            return kind(v).isin("integer", "number") & (F.try_variant_get(v, "$", "double") == float(x))
        return (kind(v) == "string") & (F.try_variant_get(v, "$", "string") == x)

    def branches() -> Column:
        tried = F.array(*[F.struct(_problems(v, s, path, root, levels - 1).alias("e")) for s in schema["anyOf"]])
        depth = lambda e: F.coalesce(F.array_max(F.transform(e, lambda x: F.length(F.substring_index(x, ":", 1)))), F.lit(0))

        def told(all_: Column) -> Column:
            deepest = F.array_max(F.transform(all_, lambda b: depth(b["e"])))
            best = F.get(F.filter(all_, lambda b: depth(b["e"]) == deepest), F.lit(0))["e"]
            return F.when(F.exists(all_, lambda b: F.size(b["e"]) == 0), none).otherwise(F.array(F.concat(path, F.lit(": anyOf; closest: "), F.get(best, F.lit(0)))))

        return let(tried, told)

    if "anyOf" in schema:
        return branches()

    def of(k: Column) -> Column:
        found = []
        number, string, is_object, is_list = k.isin("integer", "number"), k == "string", k == "object", k == "array"
        for name, ok in (("minimum", lambda x, b: x >= b), ("maximum", lambda x, b: x <= b)):
            if name in schema:
                found.append(F.when(number & ~ok(F.try_variant_get(v, "$", "double"), F.lit(float(schema[name]))), F.array(say(name))))
        for name, ok in (("minLength", lambda n, b: n >= b), ("maxLength", lambda n, b: n <= b)):
            if name in schema:
                found.append(F.when(string & ~ok(F.length(F.try_variant_get(v, "$", "string")), F.lit(schema[name])), F.array(say(name))))
        child = lambda name: F.try_variant_get(v, f"$['{name}']", "variant")

        def under(name: str, below: dict) -> Column:
            return let(child(name), lambda c: F.when(c.isNotNull(), _problems(c, below, F.concat(path, F.lit(f".{name}")), root, levels - 1)))

        for name in schema.get("required", []):
            found.append(F.when(is_object & child(name).isNull(), F.array(say(f"missing required {name}"))))
        properties = schema.get("properties", {})
        for name, below in properties.items():
            found.append(F.when(is_object, under(name, below)))
        if schema.get("additionalProperties") is False:
            extra = F.filter(F.map_keys(v.cast("map<string, variant>")), lambda x: ~x.isin(*properties) if properties else F.lit(True))
            found.append(F.when(is_object, F.transform(extra, lambda x: F.concat(path, F.lit(": unexpected property "), x))))
        if "items" in schema:
            items = F.transform(v.cast("array<variant>"), lambda x, i: _problems(x, schema["items"], F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), root, levels - 1))
            found.append(F.when(is_list, F.flatten(items)))
        out = F.concat(*[F.coalesce(x, none) for x in found]) if found else none
        first = []
        if "const" in schema:
            first.append((~F.coalesce(literal(schema["const"]), F.lit(False)), "const"))
        if "enum" in schema:
            met = F.lit(False)
            for x in schema["enum"]:
                met = met | F.coalesce(literal(x), F.lit(False))
            first.append((~met, "enum"))
        if "type" in schema:
            types = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
            first.append((~k.isin(*types, *(["integer"] if "number" in types else [])), "type"))
        for bad, rule in reversed(first):
            out = F.when(bad, F.array(say(rule))).otherwise(out)
        return out

    return let(kind(v), of)
