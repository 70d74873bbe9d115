from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from winnow.functions import binning, drift, hashing, tags, vectors


def one(spark, **exprs):
    return spark.range(1).select(*[e.alias(n) for n, e in exprs.items()]).first()


def lits(*values):
    return [F.lit(float(v)) for v in values]


def test_vector_expressions(spark):
    a, b = F.lit([3.0, 4.0]), F.lit([1.0, 2.0])
    row = one(spark, dot=vectors.dot(a, b), norm=vectors.norm(a), l2=vectors.squared_l2(a, b),
              unit=vectors.l2_normalize(a), zero=vectors.l2_normalize(F.lit([0.0, 0.0])))
    assert row["dot"] == 11 and row["norm"] == 5 and row["l2"] == 8
    assert row["unit"] == pytest.approx([0.6, 0.8]) and row["zero"] == [0.0, 0.0]


def test_tag_flags_by_substring_and_by_token(spark):
    df = spark.createDataFrame([(1, "WAR|DRAMA"), (2, "WARRIOR"), (3, None)], "id int, g string")
    rows = df.select("id", tags.flag(F.col("g"), "WAR").alias("s"), tags.flag(F.col("g"), "WAR", "token").alias("t"))
    assert [(r.s, r.t) for r in rows.orderBy("id").collect()] == [(1, 1), (1, 0), (0, 0)]
    assert tags.slug("Film-Noir") == "film_noir" and tags.slug("Children's") == "childrens"
    assert one(spark, s=tags.slug_column(F.lit("Children's-X")))["s"] == "childrens_x"


def test_bins(spark):
    df = spark.createDataFrame([(v,) for v in (1, 5, 6, 10, 50, 51)], "v int")
    label = binning.right_closed(F.col("v"), (5, 10, 20, 50), ("1-5", "6-10", "11-20", "21-50", "50+"))
    assert [r[0] for r in df.orderBy("v").select(label).collect()] == ["1-5", "1-5", "6-10", "6-10", "21-50", "50+"]
    edges = F.lit([0.0, 1.0, 2.0])
    for value, wanted in ((-5, 0), (0, 0), (0.5, 0), (1, 1), (2, 1), (9, 1)):
        assert one(spark, b=binning.histogram_bin(F.lit(float(value)), edges))["b"] == wanted


def test_mean_shift(spark):
    z = drift.mean_shift_z
    row = one(spark, a=z(*lits(10.0, 4.0, 7.0)), b=z(*lits(1, 0, 2)), c=z(*lits(1, 0, 1)), d=z(*lits(1, 1e-10, 2)))
    assert row["a"] == pytest.approx(0.75) and row["b"] == math.inf and row["c"] == 0
    assert row["d"] == pytest.approx(1e10)  # the stored floor is not treated as constant


def test_gaussian_kl(spark):
    kl = drift.gaussian_kl
    row = one(spark, same=kl(*lits(1, 2, 1, 2)), shift=kl(*lits(1, 1, 0, 1)), wide=kl(*lits(0, 2, 0, 1)),
              sym=drift.symmetric_kl(*lits(0, 2, 0, 1)))
    assert row["same"] == 0 and row["shift"] == pytest.approx(0.5)
    assert row["wide"] == pytest.approx(-math.log(2) + 2 - 0.5)
    back = math.log(2) + 1 / 8 - 0.5
    assert row["sym"] == pytest.approx((row["wide"] + back) / 2)


def test_psi_of_arrays(spark):
    base, online = F.lit([0.5, 0.5]), F.lit([0.9, 0.1])
    row = one(spark, same=drift.psi(base, base), moved=drift.psi(base, online), empty=drift.psi(F.lit([1.0, 0.0]), base))
    assert row["same"] == 0
    assert row["moved"] == pytest.approx(0.4 * math.log(1.8) + -0.4 * math.log(0.2))
    assert row["empty"] > 0.1
    with pytest.raises(Exception, match="differ in length"):
        one(spark, bad=drift.psi(base, F.lit([1.0])))


def test_severity_keeps_the_worst_level_unless_compat(spark):
    s = drift.severity
    row = one(
        spark, ok=s(*lits(0, 0)), warn=s(*lits(2, 0)), alert=s(*lits(3.0, 0.4)), compat=s(*lits(3.0, 0.4), compat=True),
        psi=s(F.lit(0.0), F.lit(0.0), F.lit(0.2)), both=s(*lits(3, 0.6), compat=True),
    )
    assert (row["ok"], row["warn"], row["alert"], row["psi"]) == ("ok", "warning", "alert", "alert")
    assert row["compat"] == "warning" and row["both"] == "alert"


def test_strides_visit_every_index():
    for n in (1, 2, 7, 100, 2000):
        for stride, inverse in hashing.coprime_strides(n):
            assert len({(r * stride) % n for r in range(n)}) == n
            assert n == 1 or (stride * inverse) % n == 1


def test_seeded_columns_depend_on_seed_and_values(spark):
    df = spark.range(1000).select(
        hashing.seeded_int(1, "id").alias("a"), hashing.seeded_int(2, "id").alias("b")
    ).toPandas()
    assert (df.a != df.b).mean() > 0.99 and df.a.between(0, 2**32 - 1).all()
    assert abs(np.mean(df.a) / 2**31 - 1) < 0.1
