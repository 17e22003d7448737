"""Intervals by resampling, and the statistics of raters that go with them.

Draws come from digests of what is drawn, so they are the same on every run and engine. Values are
packed into slices, and tasks share the draws: each meets the values of its group, eight million of
them at most, with the picks of its draws, and sends on a sum for each draw. A larger group is met
in blocks of so many, with all its picks for each block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from quillboard.functions.draws import resampled_sums
from quillboard.sources.shared import stored

#: Values of a slice, of a block that a task holds, picks that are worth a task of their own, and tasks to a block at most.
SLICE, BLOCK, PICKS, TASKS = 1 << 16, 1 << 23, 1 << 25, 16
DRAWS = 20_000


def _pick(key: Column, k: Column, of: Column) -> Column:
    """One of ``of`` by the k-th eight digits of a digest of the key, four to a digest."""
    return F.conv(F.substring(key, (k % 4 * 8 + 1).cast("int"), F.lit(8)), 16, 10).cast("long") % of


def _ends(draws: DataFrame, by: list[str], value: str, n: int, alpha: float) -> DataFrame:
    """Order statistics of the draws at both ends; at most ``n`` values to a group."""
    m = F.array_sort(F.collect_list(value))
    per = draws.groupBy(*by).agg(m.alias("m")) if by else draws.agg(m.alias("m"))
    return per.select(*by, F.get("m", F.lit(int(alpha / 2 * n))).alias("lo"), F.get("m", F.lit(min(int((1 - alpha / 2) * n), n - 1))).alias("hi"))


def _shared_out(packed: DataFrame, picks: Column) -> DataFrame:
    """Slices once for each task that is to meet them: columns ``task`` out of ``tasks``, and ``block``."""
    tasks = F.least(F.lit(TASKS), F.greatest(F.lit(1), F.ceil(picks / PICKS))).cast("int")
    rows = packed.withColumns({"tasks": tasks, "block": F.expr(f"o div {BLOCK}")})
    return rows.withColumn("task", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)))


def _resampled(prefixes: list[bytes], n: int, slices: pa.Table, columns: list[str], suffix: bytes = b"") -> list[tuple[np.ndarray, np.ndarray]]:
    """For each column the sums of its picks and how many of them were nulls; the slices are in their order."""
    low, values = int(slices["o"][0].as_py()), []
    for c in columns:
        flat = pa.concat_arrays([chunk.flatten() for chunk in slices[c].chunks])
        values.append(flat.fill_null(0.0).to_numpy())
        if flat.null_count:
            values.append(flat.is_null().to_numpy(zero_copy_only=False).astype(float))
        else:
            values.append(None)
    sums = iter(resampled_sums(prefixes, n, low, [v for v in values if v is not None], suffix))
    found = [np.zeros(len(prefixes)) if v is None else next(sums) for v in values]
    return list(zip(found[::2], found[1::2], strict=True))


def ratio_interval(rows: DataFrame, group: str, unit: str, draws: int = DRAWS, alpha: float = 0.05) -> DataFrame:
    """(group, units, lo, hi) of sum(num) / sum(den), resampling the units of each group with replacement.

    rows: (group, unit, num, den), a row for each unit. Units are in order of the first two digits of their
    digests, then of themselves: a slice holds those of two digits, a 256th of a group.
    """
    rows = rows.select(F.col(group).alias("g"), F.col(unit).alias("u"), F.col("num").cast("double").alias("num"), F.col("den").cast("double").alias("den"))
    slices = rows.groupBy("g", F.substring(F.md5(F.col("u").cast("string")), 1, 2).alias("b")).agg(F.sort_array(F.collect_list(F.struct("u", "num", "den"))).alias("s"))
    packed = stored(slices.select("g", "b", F.size("s").alias("n"), F.col("s.num").alias("num"), F.col("s.den").alias("den")), "slices")
    order = Window.partitionBy("g").orderBy("b")  # 256 rows to a group, without their values
    offsets = packed.select("g", "b", "n").withColumns({"o": F.sum("n").over(order) - F.col("n"), "units": F.sum("n").over(Window.partitionBy("g"))}).drop("n")
    shared = _shared_out(packed.hint("merge").join(offsets, ["g", "b"]), F.col("units") * draws)
    kind = packed.schema["g"].dataType

    def met(key: tuple, slices: pa.Table) -> pa.Table:
        g, task = key[0].as_py(), key[1].as_py()
        slices = slices.sort_by("o")
        units, tasks = slices["units"][0].as_py(), slices["tasks"][0].as_py()
        mine = range(task, draws, tasks)
        found = _resampled([f"{g}:{i}:".encode() for i in mine], units, slices, ["num", "den"])
        num, den = (pa.array(s, mask=nulls >= units) for s, nulls in found)
        return pa.table({"g": pa.array([g] * len(mine), slices["g"].type), "units": [units] * len(mine), "draw": pa.array(mine, pa.int32()), "num": num, "den": den})

    out = T.StructType([T.StructField("g", kind), T.StructField("units", T.LongType()), T.StructField("draw", T.IntegerType()), T.StructField("num", T.DoubleType()), T.StructField("den", T.DoubleType())])
    sums = shared.groupBy("g", "task", "block").applyInArrow(met, out)
    each = sums.groupBy("g", "units", "draw").agg((F.sum("num") / F.sum("den")).alias("m"))
    return _ends(each, ["g", "units"], "m", draws, alpha).withColumnRenamed("g", group)


def cluster_gap(rows: DataFrame, cluster: str, draws: int = DRAWS, alpha: float = 0.1, by: list[str] | None = None) -> DataFrame:
    """(by, a, b, gap, lo, hi): mean of side a less side b, resampling clusters and then the values of each; for each of ``by`` on its own.

    rows: (by, side 'a' or 'b', cluster, value). Values are numbered within a cluster by their size,
    so equal values may stand for each other.
    """
    by = by or []
    key = [*by, "side", "cl"]
    rows = rows.select(*by, "side", F.col(cluster).alias("cl"), F.col("value").cast("double").alias("value"))
    ranked = rows.withColumn("v", F.row_number().over(Window.partitionBy(*key).orderBy(F.asc_nulls_last("value"))) - 1)
    slices = ranked.groupBy(*key, F.expr(f"cast(v div {SLICE} as long)").alias("slice")).agg(F.sort_array(F.collect_list(F.struct("v", "value")))["value"].alias("values"), F.count("*").alias("held"), F.count("value").alias("filled"), F.sum("value").alias("total"))
    packed = stored(slices, "slices")
    sizes = packed.groupBy(*key).agg(F.sum("held").alias("n"), F.sum("filled").alias("filled"), F.sum("total").alias("total"))
    side = Window.partitionBy(*by, "side")
    sizes = stored(sizes.withColumns({"c": F.row_number().over(side.orderBy(F.asc_nulls_last("cl"))) - 1, "clusters": F.count("*").over(side)}), "sizes")  # a row for each cluster
    slots = sizes.select(*by, "side", "clusters", F.col("c").alias("slot"), F.explode(F.sequence(F.lit(0), F.lit(draws - 1))).alias("draw"))
    slots = slots.withColumn("c", _pick(F.md5(F.concat_ws(":", "side", "draw", "slot")), F.lit(0), F.col("clusters")).cast("int"))
    ready = sizes.select(*key, "c", "n").withColumn("tasks", F.least(F.lit(TASKS), F.greatest(F.lit(1), F.ceil(F.col("n") * draws / PICKS))).cast("int"))
    picked = slots.hint("merge").join(ready, [*by, "side", "c"]).groupBy(*key, "n", (F.col("draw") % F.col("tasks")).alias("task")).agg(F.collect_list(F.struct("draw", "slot")).alias("picks"))
    each = packed.select(*key, "values", (F.col("slice") * SLICE).alias("o")).withColumn("block", F.expr(f"o div {BLOCK}"))
    shared = picked.hint("merge").join(each, key).select(*key, "n", "task", "block", "o", "values", F.col("picks.draw").alias("draw"), F.col("picks.slot").alias("slot"))

    def met(key: tuple, slices: pa.Table) -> pa.Table:
        slices = slices.sort_by("o")
        side, n = slices["side"][0].as_py(), int(slices["n"][0].as_py())
        at, slot = (slices[c].combine_chunks()[0].values.to_numpy() for c in ("draw", "slot"))
        total, nulls = _resampled([f"{side}:{i}:{c}:".encode() for i, c in zip(at.tolist(), slot.tolist(), strict=True)], n, slices, ["values"], b":v")[0]
        drawn, where = np.unique(at, return_inverse=True)
        first = n if slices["o"][0].as_py() == 0 else 0  # picks are counted once, nulls where they are
        out = {c: pa.array([slices[c][0].as_py()] * len(drawn), slices[c].type) for c in [*by, "side"]}
        return pa.table(out | {"draw": pa.array(drawn, pa.int32()), "total": np.bincount(where, total), "n": np.bincount(where, first - nulls).astype(np.int64)})

    kinds = packed.schema
    out = T.StructType([*[kinds[c] for c in [*by, "side"]], T.StructField("draw", T.IntegerType()), T.StructField("total", T.DoubleType()), T.StructField("n", T.LongType())])
    sums = shared.groupBy(*key, "task", "block").applyInArrow(met, out)
    a, b = F.col("side") == "a", F.col("side") == "b"
    mean = lambda s, of: F.sum(F.when(s, F.col("total"))) / F.nullif(F.sum(F.when(s, F.col(of))), F.lit(0))
    means = sums.groupBy(*by, "draw").agg((mean(a, "n") - mean(b, "n")).alias("m"))
    n = lambda s: F.coalesce(F.sum(F.when(s, F.col("n"))), F.lit(0))
    whole = [n(a).alias("a"), n(b).alias("b"), (mean(a, "filled") - mean(b, "filled")).alias("gap")]
    ends = _ends(means, by, "m", draws, alpha)
    if by:
        return sizes.groupBy(*by).agg(*whole).join(ends, by)
    return sizes.agg(*whole).crossJoin(F.broadcast(ends))  # one row each


def equivalence(lo: Column, hi: Column, bound: float) -> Column:
    """PASS inside the bound, FAIL on or beyond it, else INCONCLUSIVE; an inverted interval stops the job."""
    verdict = F.when((lo > -bound) & (hi < bound), "PASS").when((lo >= bound) | (hi <= -bound), "FAIL").otherwise("INCONCLUSIVE")
    return F.when(lo > hi, F.raise_error(F.lit("inverted interval")).cast("string")).otherwise(verdict)


def combined(verdict: str) -> Column:
    """Of a group's verdicts: any FAIL fails, all PASS pass, anything else is INCONCLUSIVE."""
    return F.when(F.bool_or(F.col(verdict) == "FAIL"), "FAIL").when(F.bool_and(F.col(verdict) == "PASS"), "PASS").otherwise("INCONCLUSIVE")


def distinct_resamples(n: Column) -> Column:
    """How many resamples with replacement of n units differ: 2n - 1 over n; 0 without units."""
    return F.when(n > 0, F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(n, F.lit(1)).cast("long")), F.lit(1.0), lambda s, i: s * (n - 1 + i) / i)).otherwise(0.0)


def half_width(sd: Column, icc: Column, left: Column, right: Column, m: Column) -> Column:
    """Half of a 90 % interval of a difference of group means of ``left`` and ``right`` people with m recordings each."""
    return 1.645 * F.sqrt(sd * sd * (icc + (1 - icc) / m) * (1 / left + 1 / right))


def two_way_icc(rows: DataFrame, unit: str, rater: str, value: str) -> DataFrame:
    """n, k, ICC(2,1) of agreement and ICC(3,1) of consistency over units that every rater has rated, whatever their number."""
    cells = rows.groupBy(unit, rater).agg(F.avg(value).alias("x"))
    panel = cells.agg(F.count_distinct(rater).alias("panel"))  # one row
    full = cells.withColumn("have", F.count("*").over(Window.partitionBy(unit))).crossJoin(F.broadcast(panel)).where("have = panel")
    units = full.groupBy(unit).agg(F.sum("x").alias("s")).agg(F.count("*").alias("n"), F.sum(F.col("s") * F.col("s")).alias("uu"))
    raters = full.groupBy(rater).agg(F.sum("x").alias("s")).agg(F.count("*").alias("k"), F.sum(F.col("s") * F.col("s")).alias("rr"))
    total = full.agg(F.sum("x").alias("t"), F.sum(F.col("x") * F.col("x")).alias("q"))
    one = units.crossJoin(raters).crossJoin(total)  # one row each
    one = one.selectExpr("n", "k", "uu / k - t * t / (n * k) ssu", "rr / n - t * t / (n * k) ssr", "q - t * t / (n * k) sst")
    one = one.selectExpr("n", "k", "ssu / (n - 1) msu", "ssr / (k - 1) msr", "(sst - ssu - ssr) / ((n - 1) * (k - 1)) mse")
    return one.selectExpr("n", "k", "round((msu - mse) / (msu + (k - 1) * mse + k * (msr - mse) / n), 6) icc21", "round((msu - mse) / (msu + (k - 1) * mse), 6) icc31")
