"""Feature tables for lookup: key/value layout, upserts, checks, layered reads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.operators.ranks import top_k
from winnow.runtime import materialize

OPEN_KINDS = 16
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def to_key_value(df: DataFrame, entity: str, id_column: str, group: str,
                 fields: Sequence[str]) -> DataFrame:
    """``(key, field, value)`` rows with keys like ``features:user:7:stats``."""
    key = F.format_string(f"features:{entity}:%s:{group}", F.col(id_column).cast("string"))
    doubles = df.select(key.alias("key"), *[F.col(c).cast("double").alias(c) for c in fields])
    return doubles.unpivot(["key"], list(fields), "field", "value")


def publish(snapshot: DataFrame, path: str, partition: str = "kind") -> None:
    """Writes a key/value snapshot, one folder per kind of key.

    Publishing again replaces exactly the kinds that are written.  A task keeps one
    file open per kind, so it need not sort its rows by kind first; beyond
    ``OPEN_KINDS`` kinds Spark sorts the rest.
    """
    with_kind = snapshot.withColumn(partition, key_kind())
    conf = snapshot.sparkSession.conf
    before = conf.get(_WRITERS, None)
    conf.set(_WRITERS, str(OPEN_KINDS))
    try:
        (
            with_kind.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition).parquet(path)
        )
    finally:
        conf.unset(_WRITERS) if before is None else conf.set(_WRITERS, before)


def key_kind():
    """Entity and group of a key, without the id."""
    return F.concat_ws(
        "_",
        F.regexp_extract("key", r"^features:([a-z]+):[^:]+:([a-z]+)$", 1),
        F.regexp_extract("key", r"^features:([a-z]+):[^:]+:([a-z]+)$", 2),
    )


def upsert(current: DataFrame, changes: DataFrame, version: str = "version") -> DataFrame:
    """Latest value per ``(key, field)`` over both tables."""
    both = current.unionByName(changes)
    return top_k(both, ["key", "field"], [F.desc(version)], 1).drop("rank")


def reconcile(source: DataFrame, sink: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """Compares every source value with the published one."""
    published = sink.select("key", "field", F.col("value").alias("__published"), F.lit(1).alias("__hit"))
    checked = source.join(published, ["key", "field"], "left")
    found = F.col("__hit").isNotNull()
    both_null = F.col("value").isNull() & F.col("__published").isNull()
    same = both_null | F.coalesce(F.abs(F.col("value") - F.col("__published")) <= tolerance, F.lit(False))
    return checked.agg(
        F.count(F.lit(1)).alias("n_values"), F.count_if(~found).alias("n_missing"),
        F.count_if(found & ~same).alias("n_different"),
    )


def key_counts(snapshot: DataFrame) -> DataFrame:
    """Distinct keys per kind of key."""
    return snapshot.select("key").distinct().groupBy(key_kind().alias("kind")).agg(
        F.count(F.lit(1)).alias("n_keys")
    )


def layered_lookup(requests: DataFrame, primary: DataFrame, key: str,
                   fallback: Mapping[str, float] | DataFrame) -> DataFrame:
    """Features of the requested ids: the primary row, else the defaults.

    ``source`` tells which layer answered.  ``fallback`` is a mapping or a
    one-row table of the same column names.
    """
    names = [c for c in primary.columns if c != key]
    # Stored first, so that requests for a hot key can be split.
    stored = materialize(primary.withColumn("__hit", F.lit(True)), "primary")
    joined = requests.join(stored, key, "left")
    missing = F.col("__hit").isNull()
    if isinstance(fallback, DataFrame):
        one = fallback.select(*[F.col(c).cast("double").alias(f"__d_{c}") for c in names])
        joined = joined.join(F.broadcast(one))  # one row
        default = {c: F.col(f"__d_{c}") for c in names}
    else:
        default = {c: F.lit(float(fallback[c])) for c in names}
    return joined.select(
        *requests.columns,
        *[F.when(missing, default[c]).otherwise(F.col(c).cast("double")).alias(c) for c in names],
        F.when(missing, "fallback").otherwise("primary").alias("source"),
    )


def features_as_map(df: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """The features of a row as one map from name to value."""
    entries = F.map_from_arrays(
        F.lit(list(names)), F.array(*[F.col(c).cast("double") for c in names])
    )
    rest = [c for c in df.columns if c not in names and c != key]
    return df.select(key, entries.alias("features"), *rest)


def lookup_stats(lookups: DataFrame) -> DataFrame:
    """Requests, hits, misses and rates over a lookup log with a ``source`` column."""
    n = F.count(F.lit(1))
    hits = F.count_if(F.col("source") == "primary")
    misses = F.count_if(F.col("source") == "fallback")
    return lookups.agg(
        n.alias("total_requests"), hits.alias("hits"), misses.alias("misses"),
        F.coalesce(F.try_divide(hits.cast("double"), n), F.lit(0.0)).alias("hit_rate"),
        F.coalesce(F.try_divide(misses.cast("double"), n), F.lit(0.0)).alias("fallback_rate"),
    )


def lookup_log_stats(log: DataFrame) -> DataFrame:
    """Requests, hits, fallbacks, errors, rates and mean latency of a lookup log.

    ``log`` holds ``source`` (``primary``, ``fallback`` or ``error``) and ``latency_ms``.
    """
    n = F.count(F.lit(1))
    counts = {name: F.count_if(F.col("source") == kind) for name, kind in
              (("hits", "primary"), ("misses", "fallback"), ("errors", "error"))}
    share = lambda c: F.coalesce(F.try_divide(c.cast("double"), n), F.lit(0.0))
    return log.agg(
        n.alias("total_requests"), *[c.alias(name) for name, c in counts.items()],
        share(counts["hits"]).alias("hit_rate"), share(counts["errors"]).alias("error_rate"),
        F.coalesce(F.avg("latency_ms"), F.lit(0.0)).alias("mean_latency_ms"),
    )
