"""Distances between a stored baseline and online statistics, as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The smallest spread or share used in a quotient, and the
# (warning, alert) thresholds of each distance.
FLOOR = 1e-10
Z_LIMITS = (2.0, 3.0)
KL_LIMITS = (0.3, 0.5)
PSI_LIMITS = (0.1, 0.2)

SEVERITIES = ("ok", "warning", "alert")


def mean_shift_z(base_mean: Column, base_std: Column, online_mean: Column) -> Column:
    gap = F.abs(online_mean - base_mean)
    constant = base_std < FLOOR
    return (
        F.when(constant & (gap > FLOOR), F.lit(float("inf")))
        .when(constant, F.lit(0.0))
        .otherwise(F.try_divide(gap, base_std))
    )


def gaussian_kl(p_mean: Column, p_std: Column, q_mean: Column, q_std: Column) -> Column:
    """KL(P || Q) of two normal distributions, never negative."""
    sp = F.greatest(p_std, F.lit(FLOOR))
    sq = F.greatest(q_std, F.lit(FLOOR))
    gap = p_mean - q_mean
    value = F.ln(sq / sp) + (sp * sp + gap * gap) / (2 * sq * sq) - 0.5
    return F.greatest(value, F.lit(0.0))


def symmetric_kl(a_mean: Column, a_std: Column, b_mean: Column, b_std: Column) -> Column:
    return (gaussian_kl(a_mean, a_std, b_mean, b_std) + gaussian_kl(b_mean, b_std, a_mean, a_std)) / 2


def psi_term(base_share: Column, online_share: Column) -> Column:
    """One bin's part of the population stability index."""
    b = F.when(base_share <= 0, F.lit(FLOOR)).otherwise(base_share)
    o = F.when(online_share <= 0, F.lit(FLOOR)).otherwise(online_share)
    return (o - b) * F.ln(o / b)


def psi(base_shares: Column, online_shares: Column) -> Column:
    """Index of two share arrays; arrays of different length are an error."""
    pairs = F.zip_with(base_shares, online_shares, lambda b, o: psi_term(b, o))
    total = F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x)
    mismatch = F.size(base_shares) != F.size(online_shares)
    return F.when(
        mismatch, F.raise_error(F.lit("share arrays differ in length")).cast("double")
    ).otherwise(total)


def _level(value: Column, limits: tuple[float, float]) -> Column:
    warning, alert = limits
    return (
        F.when(value >= alert, F.lit(2)).when(value >= warning, F.lit(1)).otherwise(F.lit(0))
    )


def severity(z: Column, kl: Column, psi_value: Column | None = None, compat: bool = False) -> Column:
    """Worst level over the distances.

    With ``compat`` a later, milder finding replaces a worse one, which is
    what comparing the level names as text does ("warning" > "alert").
    """
    levels = [_level(z, Z_LIMITS), _level(kl, KL_LIMITS)]
    if psi_value is not None:
        levels.append(F.coalesce(_level(psi_value, PSI_LIMITS), F.lit(0)))
    if compat:
        text_order = F.lit([0, 2, 1])
        worst = F.greatest(*[F.get(text_order, lv) for lv in levels])
        return F.get(F.lit(["ok", "alert", "warning"]), worst)
    return F.get(F.lit(list(SEVERITIES)), F.greatest(*levels))
