"""Feature baselines, online statistics and drift, batch and streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from winnow.catalog.bindings import *  # noqa: F403
from winnow.catalog.bindings import R
from winnow.catalog.feature_queries import NUMERIC
from winnow.catalog.registry import ORACLES, query
from winnow.operators import drift
from winnow.sources import files
from winnow.streaming import drift_stream, snapshots

FEATURES = f"""{stats_ctes()}, {features_sql()},
t as (select * from features where split = 'train'),
exact as ({' union all '.join(f"select '{c}' as feature, cast({c} as double) as value from t" for c in NUMERIC)}),
long as (select feature, round(value, 6) as value from exact)"""
PCT = {f"p{round(p * 100):02d}": p for p in drift.PERCENTILES}


def _train_long(spark, sf, digits=None):
    data = split(spark, sf)
    p = parts(spark, sf, data)
    wide = p.matrix(part_of(data, "train"), ["user_id", "item_id"])
    chosen = wide.select(*[F.round(c, digits).alias(c) if digits else F.col(c) for c in NUMERIC])
    # Written once in wide form: the statistics read the rows several times.
    return drift.to_long(materialize(chosen), NUMERIC)


@query("feature_baseline", f"""with {FEATURES} select feature, {R('avg(value)')} as mean,
  {R('coalesce(nullif(stddev_samp(value), 0), 1e-10)')} as std, {R('min(value)')} as min, {R('max(value)')} as max,
  count(value) as n_samples, {', '.join(f"{R(f'quantile_cont(value, {p})')} as {n}" for n, p in PCT.items())}
from exact group by feature""")
def _(spark, sf):
    return drift.feature_baseline(_train_long(spark, sf))


@query("baseline_roundtrip", ORACLES["feature_baseline"])
def _(spark, sf):
    """The baseline as a later run reads it."""
    path = staging_path(spark, "baseline")
    files.save_table(drift.feature_baseline(_train_long(spark, sf)), path)
    return files.read_table(spark, path)


def edges_sql(source: str) -> str:
    """CTEs ``bins(feature, bin, lower, upper, last)`` from distinct quantile edges."""
    return f"""cuts as (select feature, list_sort(list_distinct(quantile_cont(value, [{', '.join(str(i / 10) for i in range(11))}]))) as e
  from {source} group by feature),
edges as (select feature, case when len(e) = 1 then [e[1], e[1] + 1e-10] else e end as e from cuts),
bins as (select feature, b as bin, e[b + 1] as lower, e[b + 2] as upper, b = len(e) - 2 as last
  from edges, unnest(range(len(e) - 1)) as t(b))"""


def histogram_sql(source: str, name: str) -> str:
    """CTE ``name(feature, bin, lower, upper, n, share)``; outer bins are open-ended."""
    return f"""{name}_n as (select feature, bin, count(*) as n from {source} join bins using (feature)
  where (value >= lower or bin = 0) and (value < upper or last) group by feature, bin),
{name} as (select b.feature, b.bin, b.lower, b.upper, coalesce(h.n, 0) as n,
  coalesce(h.n / sum(h.n) over (partition by b.feature), 0) as share
  from bins b left join {name}_n h on b.feature = h.feature and b.bin = h.bin)"""


@query("baseline_histogram", f"""with {FEATURES}, {edges_sql('long')}, {histogram_sql('long', 'hist')}
select feature, cast(bin as integer) as bin, {R('lower')} as lower, {R('upper')} as upper, n, {R('share')} as share from hist""")
def _(spark, sf):
    # Edges are values of the column, so their last bits must not depend on row order.
    long = _train_long(spark, sf, digits=6)
    return drift.histogram(long, drift.histogram_edges(long))


def moments_sql(source: str, keys: str = "feature") -> str:
    return (f"select {keys}, count(value) as count, avg(value) as mean, var_pop(value) * count(value) as m2, "
            f"min(value) as min, max(value) as max, stddev_pop(value) as std from {source} group by {keys}")


MOMENTS = ", ".join([f"{R(c)} as {c}" for c in ("mean", "min", "max", "std")] + [f"{R('m2 / count')} as variance"])


def _shown(state):
    """The state with m2 per row: m2 itself is too large for a fixed number of decimals."""
    return state.withColumn("variance", F.col("m2") / F.col("count")).drop("m2")


@query("online_stats", f"with {DRIFT_LOG_SQL}, o as ({moments_sql('(select * from drift_log where part = ' + repr('online') + ')')}) select feature, count, {MOMENTS} from o")
def _(spark, sf):
    log = drift_log(spark, sf)
    watched = log.where(F.col("part") == "baseline").select("feature").distinct()
    return _shown(drift.moments(log.where(F.col("part") == "online"), monitored=watched))


@query("online_stats_json", f"with {FEATURE_LOG_SQL}, o as ({moments_sql('feature_log')}) select feature, count, {MOMENTS} from o")
def _(spark, sf):
    # Export and import of the state: the statistics survive the round trip.
    return _shown(drift.moments_from_json(drift.moments_json(drift.moments(feature_log(spark, sf)))))


@query("merge_moments", f"with {FEATURE_LOG_SQL}, o as ({moments_sql('feature_log')}) select feature, count, {MOMENTS} from o")
def _(spark, sf):
    hourly = drift_stream.windowed_stats(feature_log(spark, sf))
    return _shown(drift.merge_moments(hourly))


@query("merge_moments_daily", f"""with {FEATURE_LOG_SQL}, d as (select cast(ts as date) as day, feature, value from feature_log),
o as ({moments_sql('d', 'day, feature')}) select day, feature, count, {MOMENTS} from o""")
def _(spark, sf):
    hourly = drift_stream.windowed_stats(feature_log(spark, sf))
    return _shown(drift.merge_moments(hourly.withColumn("day", F.col("window_start").cast("date")), ["day", "feature"]))


# --- reports ----------------------------------------------------------------

KL = "ln(greatest({q}, 1e-10) / greatest({p}, 1e-10)) + (greatest({p}, 1e-10) ** 2 + ({a} - {b}) ** 2) / (2 * greatest({q}, 1e-10) ** 2) - 0.5"
KL_ONLINE = f"greatest({KL.format(p='online_std', q='baseline_std', a='online_mean', b='baseline_mean')}, 0)"
KL_BACK = f"greatest({KL.format(p='baseline_std', q='online_std', a='online_mean', b='baseline_mean')}, 0)"


def _steps(value: str, low: float, high: float) -> str:
    return f"case when {value} >= {high} then 2 when {value} >= {low} then 1 else 0 end"


def report_ctes(online: str, keys: str = "", psi: str | None = None, psi_by_keys: bool = False) -> str:
    """CTE ``report`` from CTEs ``base`` (feature, mean, std) and ``online``; PSI per feature or, if
    ``psi_by_keys``, per ``keys`` and feature."""
    k = f"{keys}, " if keys else ""
    psi_using = f"{k}feature" if psi_by_keys else "feature"
    levels = [_steps("z_score", 2, 3), _steps("kl", 0.3, 0.5)] + ([_steps("psi", 0.1, 0.2)] if psi else [])
    return f"""j as (select {k}o.feature, b.mean as baseline_mean, b.std as baseline_std, o.count as online_count,
  o.mean as online_mean, o.std as online_std{', p.psi' if psi else ''} from {online} o join base b using (feature)
  {f'left join {psi} p using ({psi_using})' if psi else ''}),
d as (select *, abs(online_mean - baseline_mean) / baseline_std as z_score, {KL_ONLINE} as kl,
  ({KL_ONLINE} + {KL_BACK}) / 2 as symmetric_kl, online_mean - baseline_mean as mean_diff,
  online_std / baseline_std as std_ratio from j),
report as (select *, ['ok', 'warning', 'alert'][1 + greatest({', '.join(levels)})] as severity,
  online_count >= 100 as sufficient_samples from d)"""


REPORT_DOUBLES = ["baseline_mean", "baseline_std", "online_mean", "online_std", "z_score", "kl", "symmetric_kl",
                  "mean_diff", "std_ratio"]
REPORT_COLUMNS = ", ".join(["feature", "online_count", *[f"{R(c)} as {c}" for c in REPORT_DOUBLES], "severity", "sufficient_samples"])
BASE = f"""{DRIFT_LOG_SQL}, base_rows as (select * from drift_log where part = 'baseline'),
online_rows as (select * from drift_log where part = 'online'),
base as (select feature, avg(value) as mean, coalesce(nullif(stddev_samp(value), 0), 1e-10) as std from base_rows group by feature)"""
PSI = f"""{edges_sql('base_rows')}, {histogram_sql('base_rows', 'bh')}, {histogram_sql('online_rows', 'oh')},
shares as (select feature, bin, case when b.share <= 0 then 1e-10 else b.share end as bs,
  case when o.share <= 0 then 1e-10 else o.share end as os from bh b join oh o using (feature, bin)),
psi as (select feature, sum((os - bs) * ln(os / bs)) as psi from shares group by feature)"""
REPORT = f"{BASE}, {PSI}, online as ({moments_sql('online_rows')}), {report_ctes('online', psi='psi')}"


def _sides(spark, sf):
    log = materialize(drift_log(spark, sf).select("ts", "feature", "value", "part"))
    return log.where(F.col("part") == "baseline"), log.where(F.col("part") == "online")


def _psi(base, online):
    edges = drift.histogram_edges(base)
    return drift.population_stability(drift.histogram(base, edges), drift.histogram(online, edges))


def _report(spark, sf, compat=False):
    base, online = _sides(spark, sf)
    return drift.drift_report(
        drift.feature_baseline(base), drift.moments(online), _psi(base, online), compat=compat
    )


@query("psi", f"with {BASE}, {PSI} select feature, {R('psi')} as psi from psi")
def _(spark, sf):
    return _psi(*_sides(spark, sf))


@query("drift_report", f"with {REPORT} select {REPORT_COLUMNS}, {R('psi')} as psi from report")
def _(spark, sf):
    return _report(spark, sf)


@query("drift_report_compat", f"""with {REPORT},
c as (select *, greatest(['ok', 'warning', 'alert'][1 + {_steps('z_score', 2, 3)}], ['ok', 'warning', 'alert'][1 + {_steps('kl', 0.3, 0.5)}],
  ['ok', 'warning', 'alert'][1 + {_steps('psi', 0.1, 0.2)}]) as text_severity,
  greatest({_steps('z_score', 2, 3)}, {_steps('kl', 0.3, 0.5)}, {_steps('psi', 0.1, 0.2)}) as level from report)
select feature, case when text_severity = 'ok' and level > 0 then 'alert' when text_severity = 'ok' then 'ok'
  else text_severity end as severity from c""")
def _(spark, sf):
    return _report(spark, sf, compat=True).select("feature", "severity")


@query("drift_summary", f"""with {REPORT} select count(*) as num_features, count(*) filter (severity = 'ok') as num_ok,
  count(*) filter (severity = 'warning') as num_warning, count(*) filter (severity = 'alert') as num_alert,
  max(online_count) as online_samples,
  coalesce(string_agg(feature, ',' order by feature) filter (severity = 'alert'), '') as alerting_features,
  coalesce(string_agg(feature, ',' order by feature) filter (severity = 'warning'), '') as warning_features,
  case when count(*) filter (severity = 'alert') > 0 then 'alert' when count(*) filter (severity = 'warning') > 0 then 'warning'
       else 'ok' end as status from report""")
def _(spark, sf):
    summary = drift.drift_summary(_report(spark, sf))
    lists = {c: F.array_join(c, ",") for c in ("alerting_features", "warning_features")}
    return summary.withColumns(lists)


# --- windows ----------------------------------------------------------------

HOURLY = moments_sql("(select date_trunc('hour', ts) as window_start, feature, value from feature_log)", "window_start, feature")
HOURLY_SQL = f"with {FEATURE_LOG_SQL}, o as ({HOURLY}) select window_start, feature, count, {MOMENTS} from o"


@query("windowed_stats", HOURLY_SQL)
def _(spark, sf):
    return _shown(drift_stream.windowed_stats(feature_log(spark, sf)))


WINDOWED = f"""{BASE}, online as ({moments_sql("(select date_trunc('day', ts) as window_start, feature, value from online_rows)", 'window_start, feature')}),
{report_ctes('online', 'window_start')}"""


def _windowed_report(spark, sf):
    base, online = _sides(spark, sf)
    daily = drift_stream.windowed_stats(online, "1 day")
    return drift_stream.windowed_drift(daily, drift.feature_baseline(base))


@query("windowed_drift", f"with {WINDOWED} select window_start, {REPORT_COLUMNS} from report")
def _(spark, sf):
    return _windowed_report(spark, sf)


def windowed_psi_sql(rows: str) -> str:
    """CTEs ``online`` (moments per day and feature of ``rows``) and ``wpsi`` (PSI per day and feature
    against the baseline's bins); needs ``bins`` and ``bh`` of the baseline."""
    return f"""ow as (select date_trunc('day', ts) as window_start, feature, value from {rows} where feature in (select feature from bins)),
online as ({moments_sql('ow', 'window_start, feature')}),
own as (select window_start, feature, bin, count(*) as n from ow join bins using (feature)
  where (value >= lower or bin = 0) and (value < upper or last) group by all),
frame as (select o.window_start, b.feature, b.bin, b.share as base_share from online o join bh b using (feature)),
wshares as (select f.window_start, f.feature, f.base_share,
  coalesce(w.n, 0) / sum(coalesce(w.n, 0)) over (partition by f.window_start, f.feature) as share
  from frame f left join own w using (window_start, feature, bin)),
wpsi as (select window_start, feature, sum((os - bs) * ln(os / bs)) as psi from (select window_start, feature,
  case when base_share <= 0 then 1e-10 else base_share end as bs, case when share <= 0 then 1e-10 else share end as os
  from wshares) group by all)"""


WINDOWED_PSI = f"""{BASE}, {edges_sql('base_rows')}, {histogram_sql('base_rows', 'bh')}, {windowed_psi_sql('online_rows')},
{report_ctes('online', 'window_start', psi='wpsi', psi_by_keys=True)}"""


def _windowed_psi_report(spark, sf):
    base, online = _sides(spark, sf)
    edges = materialize(drift.histogram_edges(base), "edges")
    state = drift_stream.windowed_state(online, edges, "1 day")
    return drift_stream.windowed_psi_drift(state, drift.feature_baseline(base), drift.histogram(base, edges))


# Days of the online part against the baseline: z-score, KL and PSI over the baseline's bins.
@query("windowed_psi_drift", f"with {WINDOWED_PSI} select window_start, {REPORT_COLUMNS}, {R('psi')} as psi from report")
def _(spark, sf):
    return _windowed_psi_report(spark, sf)


WINDOW_STATUS = f"""{WINDOWED}, s as (select window_start, count(*) as num_features,
  count(*) filter (severity = 'alert') as num_alert, count(*) filter (severity = 'warning') as num_warning,
  case when count(*) filter (severity = 'alert') > 0 then 'alert' when count(*) filter (severity = 'warning') > 0 then 'warning'
       else 'ok' end as status from report group by window_start)"""


@query("drift_history", f"with {WINDOW_STATUS} select * from s order by window_start desc limit 5")
def _(spark, sf):
    reports = drift_stream.windowed_summary(_windowed_report(spark, sf))
    return drift.report_history(reports, 5).select("window_start", "num_features", "num_alert", "num_warning", "status")


@query("drift_status", f"""with {WINDOW_STATUS} select count(*) as n_reports, max(window_start) as last_check,
  arg_max(status, window_start) as status from s""")
def _(spark, sf):
    return drift.latest_status(drift_stream.windowed_summary(_windowed_report(spark, sf)))


@query("report_history_table", f"""with {WINDOW_STATUS}, n as (select count(*) as n_reports from s)
select window_start, num_features, num_alert, num_warning, status, n_reports from s cross join n order by window_start desc limit 5""")
def _(spark, sf):
    """Reports appended in two runs to one table; history and status come from the table."""
    path = staging_path(spark, "reports")
    reports = drift_stream.windowed_summary(_windowed_report(spark, sf)).select(
        "window_start", "num_features", "num_alert", "num_warning", "status")
    reports = materialize(reports, "reports")
    newest_window = reports.agg(F.max("window_start")).first()[0]
    files.append_reports(reports.where(F.col("window_start") < newest_window), path)
    files.append_reports(reports.where(F.col("window_start") >= newest_window), path)
    stored = files.read_table(spark, path)
    newest = drift.latest_status(stored).select("n_reports")
    return drift.report_history(stored, 5).join(F.broadcast(newest))  # one row


# --- streams, drained and compared with the same SQL ------------------------

def _drain(spark, sf, build, keys, mode, transform=None):
    """Runs a stream over the event file to its end and returns the sink's latest rows."""
    events = table(spark, sf, "events").schema
    log = (
        spark.readStream.schema(events).option("pathGlobFilter", "events.parquet").parquet(sf)
        .select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("feature"), "value")
    )
    path, checkpoint = staging_path(spark, "stream"), staging_path(spark, "stream-state")
    drift_stream.start_upsert_sink(build(log), path, checkpoint, mode, transform).awaitTermination()
    return drift_stream.latest(spark, path, keys)


@query("stream_online_stats", f"with {FEATURE_LOG_SQL}, o as ({moments_sql('feature_log')}) select feature, count, {MOMENTS} from o")
def _(spark, sf):
    return _shown(_drain(spark, sf, drift_stream.online_stats, ["feature"], "complete"))


@query("stream_windowed_stats", HOURLY_SQL)
def _(spark, sf):
    out = _drain(spark, sf, drift_stream.windowed_stats, ["window_start", "feature"], "update")
    return _shown(out).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("stream_drift", f"""with {BASE}, online as ({moments_sql("(select date_trunc('day', ts) as window_start, feature, value from feature_log)", 'window_start, feature')}),
{report_ctes('online', 'window_start')} select window_start, {REPORT_COLUMNS} from report""")
def _(spark, sf):
    baseline = materialize(drift.feature_baseline(_sides(spark, sf)[0]))
    out = _drain(
        spark, sf, lambda log: drift_stream.windowed_stats(log, "1 day"), ["window_start", "feature"], "update",
        lambda batch: drift_stream.windowed_drift(batch, baseline),
    )
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


# The same report from a stream: a day's moments and bin counts are the stream's state, every
# micro-batch reports the days it changed, and the sink keeps each day's newest row.
@query("stream_psi_drift", f"""with {BASE}, {edges_sql('base_rows')}, {histogram_sql('base_rows', 'bh')}, {windowed_psi_sql('feature_log')},
{report_ctes('online', 'window_start', psi='wpsi', psi_by_keys=True)} select window_start, {REPORT_COLUMNS}, {R('psi')} as psi from report""")
def _(spark, sf):
    base = _sides(spark, sf)[0]
    edges = materialize(drift.histogram_edges(base), "edges")
    baseline, base_hist = materialize(drift.feature_baseline(base)), materialize(drift.histogram(base, edges))
    out = _drain(
        spark, sf, lambda log: drift_stream.windowed_state(log, edges, "1 day"), ["window_start", "feature"], "update",
        lambda batch: drift_stream.windowed_psi_drift(batch, baseline, base_hist),
    )
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def _drain_versioned(spark, sf, build, mode):
    """Runs a stream over the event file into a versioned sink, compacted every 10 batches."""
    events = table(spark, sf, "events").schema
    log = (
        spark.readStream.schema(events).option("pathGlobFilter", "events.parquet").parquet(sf)
        .select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("feature"), "value")
    )
    path, checkpoint = staging_path(spark, "versioned"), staging_path(spark, "versioned-state")
    keys = ["window_start", "feature"]
    snapshots.VersionedSink(path, keys, compact_every=10).start(build(log), checkpoint, mode).awaitTermination()
    out = snapshots.read(spark, path, keys)
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


# Hourly moments of a stream kept as versioned snapshots; the newest state of every window.
@query("stream_versioned_stats", HOURLY_SQL)
def _(spark, sf):
    return _shown(_drain_versioned(spark, sf, drift_stream.windowed_stats, "update"))


# Append mode: a window is written once, when the watermark (one hour after the newest event) has passed its end.
@query("stream_closed_windows", f"""with {FEATURE_LOG_SQL}, o as ({HOURLY}),
latest as (select max(ts) as t from feature_log)
select window_start, feature, count, {MOMENTS} from o, latest where window_start + interval 2 hour <= latest.t""")
def _(spark, sf):
    return _shown(_drain_versioned(spark, sf, drift_stream.windowed_stats, "append"))

