"""Exact probabilities and draws as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from farekit.llm.columns import let

# ln k! for small k; Stirling's series is exact to double precision beyond.
_SMALL = 32


def log_factorial(n: Column) -> Column:
    x = n.cast("double")
    series = (
        x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * F.pow(x, 3)) + 1 / (1260 * F.pow(x, 5))
    )
    small = F.array(*[F.lit(math.lgamma(k + 1)) for k in range(_SMALL)])
    return F.when(n < _SMALL, F.get(small, n.cast("int"))).otherwise(series)


def binomial_at_most(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), 0 < p < 1.

    The terms are summed from k downwards relative to the k-th. Those more than
    twelve standard deviations below are smaller than double precision shows.
    """
    at_k = (
        log_factorial(n) - log_factorial(k) - log_factorial(n - k)
        + k * math.log(p) + (n - k) * math.log1p(-p)
    )
    odds = (1 - p) / p
    reach = F.ceil(12 * F.sqrt(n * p * (1 - p))) + 200
    steps = F.sequence(k.cast("long"), F.greatest(F.lit(0), k - reach).cast("long"), F.lit(-1).cast("long"))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum"))
    relative = F.aggregate(
        steps,
        start,
        lambda acc, i: F.struct(
            (acc["term"] * i * odds / (n - i + 1)).alias("term"), (acc["sum"] + acc["term"]).alias("sum")
        ),
        lambda acc: acc["sum"],
    )
    return F.when(k >= n, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(at_k) * relative))


def hypergeometric(u: Column, total: Column, marked: Column, drawn: Column) -> Column:
    """How many of ``drawn`` items out of ``total`` are among the ``marked``, for ``u`` uniform in [0, 1).

    Inversion: the weights of all counts within twelve standard deviations of
    the mode follow from each other by their exact ratio; what lies beyond has
    no weight in double precision. Only ratios are used, so the weights are
    normalised by their own sum whatever the size of the numbers.
    """
    long = "long"

    def bounds(s: Column) -> Column:
        n, k, d = s["total"], s["marked"], s["drawn"]
        share = k / F.greatest(n, F.lit(1))
        mode = F.floor((d + 1).cast("double") * (k + 1) / (n + 2)).cast(long)
        spread = F.sqrt(d * share * (1 - share) * (n - d) / F.greatest(n - 1, F.lit(1)))
        reach = (F.ceil(12 * spread) + 30).cast(long)
        least, most = F.greatest(F.lit(0).cast(long), d + k - n), F.least(d, k)
        return F.struct(
            s["u"].alias("u"), n.alias("total"), k.alias("marked"), d.alias("drawn"),
            F.greatest(least, F.least(most, mode - reach)).alias("low"),
            F.least(most, F.greatest(least, mode + reach)).alias("high"),
        )

    def ratio(s: Column, x: Column) -> Column:
        n, k, d = s["total"], s["marked"], s["drawn"]
        return (k - x).cast("double") * (d - x) / ((x + 1).cast("double") * (n - k - d + x + 1))

    def walk(s: Column) -> Column:
        support = F.sequence(s["low"], s["high"])
        whole = F.aggregate(
            support,
            F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("sum")),
            lambda acc, x: F.struct((acc["p"] * ratio(s, x)).alias("p"), (acc["sum"] + acc["p"]).alias("sum")),
            lambda acc: acc["sum"],
        )
        return F.aggregate(
            support,
            F.struct(F.lit(1.0).alias("p"), (s["u"] * whole).alias("left"), F.lit(None).cast(long).alias("hit")),
            lambda acc, x: F.struct(
                (acc["p"] * ratio(s, x)).alias("p"),
                (acc["left"] - acc["p"]).alias("left"),
                F.coalesce(acc["hit"], F.when(acc["left"] < acc["p"], x)).alias("hit"),
            ),
            lambda acc: F.coalesce(acc["hit"], s["high"]),
        )

    given = F.struct(
        u.alias("u"), total.cast(long).alias("total"), marked.cast(long).alias("marked"), drawn.cast(long).alias("drawn")
    )
    return let(let(given, bounds), walk)
