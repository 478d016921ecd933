"""Numeric expressions: safe ratios and tail probabilities."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives 0 when the denominator is 0 or NULL."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def rate_per_1000(count: Column, population: Column) -> Column:
    return F.try_divide(count.cast("double"), population.cast("double")) * 1000


def to_number(text: Column) -> Column:
    """Text to double, NULL when it is not a number."""
    return text.try_cast("double")


def _polynomial(x: Column, coefficients: list[float]) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + F.lit(c)
    return out


# Rational approximation of the normal tail (Hart 1968, as given by
# West 2005), highest power first.
_HART_P = [
    3.52624965998911e-02,
    0.700383064443688,
    6.37396220353165,
    33.912866078383,
    112.079291497871,
    221.213596169931,
    220.206867912376,
]
_HART_Q = [
    8.83883476483184e-02,
    1.75566716318264,
    16.064177579207,
    86.7807322029461,
    296.564248779674,
    637.333633378831,
    793.826512519948,
    440.413735824752,
]


def normal_upper_tail(z: Column) -> Column:
    """P(Z > z) for z >= 0; Spark has no error function."""
    density = F.exp(-z * z / 2)
    body = density * _polynomial(z, _HART_P) / _polynomial(z, _HART_Q)
    far = z + 0.65
    for k in (4, 3, 2, 1):
        far = z + F.lit(float(k)) / far
    return F.when(z < 7.07106781186547, body).otherwise(density / far / math.sqrt(2 * math.pi))


def chi2_upper_tail(x: Column, dof: Column) -> Column:
    """P(X > x) for a chi-square variable with a whole number of degrees of freedom.

    Repeated integration by parts of the density gives a finite sum: even degrees start
    from exp(-x/2), odd ones from the normal tail at sqrt(x).
    """
    half = x / 2
    odd = dof % 2 == 1
    # log of the term j of the sum: half^a * exp(-half) / gamma(a + 1), a = j or j - 1/2
    first = F.when(odd, 2 * normal_upper_tail(F.sqrt(x))).otherwise(F.lit(0.0))
    steps = F.when(odd, (dof - 1) / 2).otherwise(dof / 2).cast("int")
    start = F.when(
        odd, F.sqrt(half) * F.exp(-half) / F.lit(math.gamma(1.5))
    ).otherwise(F.exp(-half))
    offset = F.when(odd, F.lit(0.5)).otherwise(F.lit(0.0))
    series = F.aggregate(
        F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>")),
        F.struct(first.alias("total"), start.alias("term")),
        lambda acc, j: F.struct(
            (acc["total"] + acc["term"]).alias("total"),
            (acc["term"] * half / (j + offset)).alias("term"),
        ),
        lambda acc: acc["total"],
    )
    return F.least(series, F.lit(1.0))
