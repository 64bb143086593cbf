"""Signed linear ratios (R4), e.g. non-bridging oxygens per tetrahedron."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


# NBO/T coefficients by element (atomic number -> coefficient).
# Numerator: Li + Na + K + Rb + Cs + 2 Mg + 2 Ca + 2 Sr + 2 Ba - Al - B
NBO_T_NUMERATOR = {3: 1, 11: 1, 19: 1, 37: 1, 55: 1, 12: 2, 20: 2, 38: 2, 56: 2, 13: -1, 5: -1}
# Denominator: Si + Al + B
NBO_T_DENOMINATOR = {14: 1, 13: 1, 5: 1}


def linear_combination(coefs: Mapping[str, float]) -> Column:
    terms = [F.col(c).cast("double") * F.lit(float(k)) for c, k in coefs.items()]
    if not terms:
        return F.lit(0.0)
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def linear_ratio(num: Mapping[str, float], den: Mapping[str, float],
                 clamp_min: float | None = 0.0) -> Column:
    """sum(num_i * x_i) / sum(den_j * x_j), clamped below at ``clamp_min``.

    A NULL input or a zero denominator gives NULL (not an error).
    """
    ratio = F.try_divide(linear_combination(num), linear_combination(den))
    if clamp_min is None:
        return ratio
    return F.when(ratio.isNull(), F.lit(None).cast("double")) \
        .otherwise(F.greatest(ratio, F.lit(float(clamp_min))))


def nbo_t(column_for: Mapping[int, str], missing: str = "error") -> Column:
    """NBO/T over element weight columns; ``column_for`` maps atomic number -> column.

    An element of the formula without a column is an error, or counts as 0 with ``missing="zero"``.
    """
    absent = sorted((set(NBO_T_NUMERATOR) | set(NBO_T_DENOMINATOR)) - set(column_for))
    if absent and missing != "zero":
        raise ValueError(f"no weight column for elements {absent}; pass missing='zero' to count them as 0")

    def coefs(table):
        return {column_for[z]: k for z, k in table.items() if z in column_for}
    return linear_ratio(coefs(NBO_T_NUMERATOR), coefs(NBO_T_DENOMINATOR))
