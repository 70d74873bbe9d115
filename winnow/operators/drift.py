"""Feature baselines, mergeable online moments and drift reports.

Tables are long: ``(feature, value)``.  The number of features is small; the
number of rows per feature is not, so every step is a grouped aggregate with
map-side partial results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.functions import drift as d
from winnow.functions.binning import histogram_bin_of
from winnow.operators.order_stats import bracket_aggregates, bracketed_quantiles
from winnow.runtime import materialize

# Fixed values
PERCENTILES = (0.05, 0.25, 0.5, 0.75, 0.95)
BINS = 10
MIN_SAMPLES = 100


def to_long(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Wide feature columns as ``(feature, value)``; columns that do not exist are skipped."""
    present = [c for c in columns if c in df.columns]
    doubles = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in present])
    return doubles.unpivot(list(keep), present, "feature", "value")


def _usable(long: DataFrame) -> DataFrame:
    return long.where(F.col("value").isNotNull() & ~F.isnan("value"))


def feature_baseline(long: DataFrame) -> DataFrame:
    """Moments, range and percentiles per feature; features without values are absent."""
    std = F.stddev_samp("value")
    # One scan for moments and quantile brackets, one for the exact values inside the brackets.
    first = materialize(_usable(long).groupBy("feature").agg(
        F.avg("value").alias("mean"),
        F.coalesce(F.nullif(std, F.lit(0.0)), F.lit(d.FLOOR)).alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.count("value").alias("n_samples"),
        *bracket_aggregates("value", PERCENTILES),
    ), "baseline_moments")  # one row per feature
    moments = first.drop("__n", "__bounds")
    spread = bracketed_quantiles(long, "feature", "value", PERCENTILES, first)
    names = [f"p{round(p * 100):02d}" for p in PERCENTILES]
    return moments.join(spread, "feature").select(
        *moments.columns, *[F.get("quantiles", F.lit(i)).alias(n) for i, n in enumerate(names)]
    )


def histogram_edges(long: DataFrame, bins: int = BINS) -> DataFrame:
    """Distinct quantile edges per feature; a constant feature gets one narrow bin."""
    probs = [i / bins for i in range(bins + 1)]
    sketched = materialize(_usable(long).groupBy("feature").agg(*bracket_aggregates("value", probs)), "edge_brackets")
    cuts = bracketed_quantiles(long, "feature", "value", probs, sketched)
    edges = F.array_distinct("quantiles")
    only = F.get(edges, F.lit(0))
    return cuts.select(
        "feature",
        F.when(F.size(edges) == 1, F.array(only, only + d.FLOOR)).otherwise(edges).alias("edges"),
    )


def histogram(long: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows and share per ``(feature, bin)`` for stored edges, empty bins included.

    ``edges`` has one row per feature with at most a few dozen numbers.
    """
    # Edges as columns are compared in generated code; an array would be walked row by row.
    width = edges.agg(F.max(F.size("edges"))).first()[0] or 0
    cuts = edges.select("feature", F.size("edges").alias("__size"), *[F.get("edges", F.lit(i)).alias(f"__e{i}") for i in range(width)])
    counts = (
        _usable(long).join(F.broadcast(cuts), "feature")
        .groupBy("feature", histogram_bin_of(F.col("value"), [F.col(f"__e{i}") for i in range(width)], F.col("__size")).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counts.groupBy("feature").agg(F.sum("n").alias("total"))
    frame = edges.select(
        "feature", "edges", F.explode(F.sequence(F.lit(0), F.size("edges") - 2)).alias("bin")
    )
    return (
        frame.join(counts, ["feature", "bin"], "left").join(totals, "feature", "left")
        .select(
            "feature", "bin",
            F.get("edges", F.col("bin")).alias("lower"), F.get("edges", F.col("bin") + 1).alias("upper"),
            F.coalesce("n", F.lit(0)).cast("long").alias("n"),
            F.coalesce(F.try_divide(F.col("n").cast("double"), F.col("total")), F.lit(0.0)).alias("share"),
        )
    )


def moments(long: DataFrame, keys: Sequence[str] = ("feature",),
            monitored: DataFrame | None = None, extra: Sequence = ()) -> DataFrame:
    """Mergeable state per key: count, mean, m2, min, max and population deviation.

    ``monitored`` (one row per feature) drops features nobody watches; ``extra``
    aggregates (bin counts, for example) are computed in the same pass.
    """
    rows = _usable(long)
    if monitored is not None:
        rows = rows.join(F.broadcast(monitored.select("feature")), "feature", "left_semi")
    return rows.groupBy(*keys).agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        (F.var_pop("value") * F.count("value")).alias("m2"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.stddev_pop("value").alias("std"), *extra,
    )


def merge_moments(parts: DataFrame, keys: Sequence[str] = ("feature",)) -> DataFrame:
    """Combines partial moments exactly; parts without rows have no influence.

    The spread around the common mean is taken as m2 plus the between-part
    variance, which is itself a weighted aggregate.
    """
    live = parts.where(F.col("count") > 0)
    n = F.sum("count")
    center = live.groupBy(*keys).agg((F.sum(F.col("count") * F.col("mean")) / n).alias("__mean"))
    off = F.col("mean") - F.col("__mean")
    return (
        live.join(center, list(keys))
        .groupBy(*keys)
        .agg(
            n.alias("count"), F.first("__mean").alias("mean"),
            F.sum(F.col("m2") + F.col("count") * off * off).alias("m2"),
            F.min("min").alias("min"), F.max("max").alias("max"),
        )
        .withColumn("std", F.when(F.col("count") < 2, 0.0).otherwise(F.sqrt(F.col("m2") / F.col("count"))))
    )


def moments_json(state: DataFrame) -> DataFrame:
    """One JSON snapshot per feature."""
    fields = ["count", "mean", "m2", "min", "max"]
    return state.select("feature", F.to_json(F.struct(*fields)).alias("json"))


def moments_from_json(snapshot: DataFrame) -> DataFrame:
    """Reads snapshots back; a stored 0 stays 0 and an absent range stays null."""
    schema = "count long, mean double, m2 double, min double, max double"
    return snapshot.select("feature", F.from_json("json", schema).alias("s")).select("feature", "s.*").withColumn(
        "std", F.when(F.col("count") < 2, 0.0).otherwise(F.sqrt(F.col("m2") / F.col("count")))
    )


def population_stability(base: DataFrame, online: DataFrame) -> DataFrame:
    """PSI per feature from two histograms over the same edges."""
    b = base.select("feature", "bin", F.col("share").alias("base_share"))
    o = online.select("feature", "bin", F.col("share").alias("online_share"))
    share = [F.coalesce(c, F.lit(0.0)) for c in ("base_share", "online_share")]
    return b.join(o, ["feature", "bin"], "left").groupBy("feature").agg(
        F.sum(d.psi_term(*share)).alias("psi")
    )


def drift_report(baseline: DataFrame, online: DataFrame, psi: DataFrame | None = None, *,
                 keys: Sequence[str] = (), compat: bool = False) -> DataFrame:
    """Distances and severity for every feature present on both sides.

    ``online`` may carry further ``keys`` (a window, for example).  The
    baseline and PSI tables have one row per feature.
    """
    base = baseline.select("feature", F.col("mean").alias("baseline_mean"), F.col("std").alias("baseline_std"))
    now = online.select(
        *keys, "feature", F.col("count").alias("online_count"), F.col("mean").alias("online_mean"),
        F.col("std").alias("online_std"),
    )
    joined = now.join(F.broadcast(base), "feature")
    if psi is not None:
        by = [k for k in keys if k in psi.columns]
        # One row per feature is broadcast; PSI per window grows with time and is joined as it is.
        side = psi.select(*by, "feature", "psi")
        joined = joined.join(side if by else F.broadcast(side), [*by, "feature"], "left")
    bm, bs, om, os_ = (F.col(c) for c in ("baseline_mean", "baseline_std", "online_mean", "online_std"))
    kl = d.gaussian_kl(om, os_, bm, bs)
    z = d.mean_shift_z(bm, bs, om)
    level = d.severity(z, kl, F.col("psi") if psi is not None else None, compat)
    return joined.select(
        *keys, "feature", "baseline_mean", "baseline_std", "online_count", "online_mean", "online_std",
        z.alias("z_score"), kl.alias("kl"), d.symmetric_kl(om, os_, bm, bs).alias("symmetric_kl"),
        *(["psi"] if psi is not None else []),
        (om - bm).alias("mean_diff"), F.when(bs > 0, os_ / bs).alias("std_ratio"),
        level.alias("severity"), (F.col("online_count") >= MIN_SAMPLES).alias("sufficient_samples"),
    )


def drift_summary(report: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Counts per severity, overall status and the features concerned.

    The lists hold feature names, one per monitored feature at most.
    """
    def count(level: str):
        return F.count_if(F.col("severity") == level)

    def names(level: str):
        return F.array_sort(F.collect_list(F.when(F.col("severity") == level, F.col("feature"))))

    return report.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("num_features"),
        *[count(level).alias(f"num_{level}") for level in d.SEVERITIES],
        F.coalesce(F.max("online_count"), F.lit(0)).cast("long").alias("online_samples"),
        names("alert").alias("alerting_features"), names("warning").alias("warning_features"),
    ).withColumn(
        "status",
        F.when(F.col("num_alert") > 0, "alert").when(F.col("num_warning") > 0, "warning").otherwise("ok"),
    )


def report_history(reports: DataFrame, limit: int, ts: str = "window_start") -> DataFrame:
    """The latest ``limit`` reports."""
    return reports.orderBy(F.desc(ts)).limit(limit)


def latest_status(reports: DataFrame, ts: str = "window_start") -> DataFrame:
    """Status of the newest report, ``not_checked`` when there is none."""
    return reports.agg(
        F.count(F.lit(1)).alias("n_reports"), F.max(ts).alias("last_check"),
        F.coalesce(F.max_by("status", ts), F.lit("not_checked")).alias("status"),
    )
