"""Special functions as columns: log gamma, the incomplete beta function, its inverse, and what follows from them.

A row takes some square roots of its counts in steps, not the counts themselves.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from quillboard.functions.dategrammar import let

TINY = 1e-300
HALVINGS = 50


def log_gamma(x: Column) -> Column:
    """The logarithm of the gamma function for x > 0, by Stirling's series from x + 8 on."""

    def series(z: Column) -> Column:
        r = 1 / (z * z)
        tail = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r * (1 / 1680 - r * (1 / 1188))))) / z
        return (z - 0.5) * F.ln(z) - z + 0.5 * math.log(2 * math.pi) + tail

    def of(v: Column) -> Column:
        rising = v
        for k in range(1, 8):
            rising = rising * (v + k)
        return let(v + 8, series) - F.ln(rising)

    return let(x.cast("double"), of)


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function by Lentz's method: two terms a step."""
    safe = lambda v: F.when(F.abs(v) < TINY, TINY).otherwise(v)
    start = let(1 / safe(1 - (a + b) * x / (a + 1)), lambda d: F.struct(F.lit(1.0).alias("c"), d.alias("d"), d.alias("h")))

    def half(s: Column, term: Column) -> Column:
        return let(F.struct((1 / safe(1 + term * s["d"])).alias("d"), safe(1 + term / s["c"]).alias("c"), s["h"].alias("h")), lambda t: F.struct(t["c"].alias("c"), t["d"].alias("d"), (t["h"] * t["c"] * t["d"]).alias("h")))

    def step(s: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return let(half(s, even), lambda t: half(t, odd))

    enough = F.ceil(2 * F.sqrt(a + b)).cast("int") + 20
    return F.aggregate(F.sequence(F.lit(1), enough), start, step)["h"]


def incomplete_beta(a: Column, b: Column, x: Column, scale: Column | None = None) -> Column:
    """The share of the beta distribution of a and b that lies below x, from 0 to 1.

    ``scale`` is the log of the beta function's inverse where it is known already. The fraction is
    taken on the side on which it settles soon.
    """

    def of(v: Column) -> Column:
        a, b, x = v["a"], v["b"], v["x"]
        front = F.exp(v["scale"] + a * F.ln(x) + b * F.ln(1 - x))
        left = x < (a + 1) / (a + b + 2)
        p, q, y = F.when(left, a).otherwise(b), F.when(left, b).otherwise(a), F.when(left, x).otherwise(1 - x)
        part = let(F.struct(p.alias("a"), q.alias("b"), y.alias("x"), front.alias("front")), lambda s: s["front"] * _fraction(s["a"], s["b"], s["x"]) / s["a"])
        return F.when(x <= 0, 0.0).when(x >= 1, 1.0).when(left, part).otherwise(1 - part)

    known = scale if scale is not None else log_gamma(a + b) - log_gamma(a) - log_gamma(b)
    return let(F.struct(a.cast("double").alias("a"), b.cast("double").alias("b"), x.cast("double").alias("x"), known.alias("scale")), of)


def beta_quantile(a: Column, b: Column, p: float) -> Column:
    """The x below which the share p of the beta distribution lies, by halving."""
    one = F.struct(a.cast("double").alias("a"), b.cast("double").alias("b"), (log_gamma(a + b) - log_gamma(a) - log_gamma(b)).alias("scale"))

    def of(v: Column) -> Column:
        def step(s: Column, _: Column) -> Column:
            mid = (s["lo"] + s["hi"]) / 2
            return let(incomplete_beta(v["a"], v["b"], mid, v["scale"]) < p, lambda low: F.when(low, F.struct(mid.alias("lo"), s["hi"].alias("hi"))).otherwise(F.struct(s["lo"].alias("lo"), mid.alias("hi"))))

        ends = F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi")), step)
        return let(ends, lambda e: (e["lo"] + e["hi"]) / 2)

    return let(one, of)


def clopper_pearson(hits: Column, of: Column, outside: float = 0.05) -> Column:
    """(lo, hi): the exact bounds of a rate of which ``outside`` lies without, half at each end; null for no trials."""
    lo = F.when(hits == 0, 0.0).otherwise(beta_quantile(hits, of - hits + 1, outside / 2))
    hi = F.when(hits == of, 1.0).otherwise(beta_quantile(hits + 1, of - hits, 1 - outside / 2))
    return F.when(of > 0, F.struct(lo.alias("lo"), hi.alias("hi")))


def two_sided_t(t: Column, freedom: Column) -> Column:
    """The probability of a t as far from 0 or farther, with so many degrees of freedom."""
    return F.when(freedom > 0, incomplete_beta(freedom / 2.0, F.lit(0.5), freedom / (freedom + t * t)))
