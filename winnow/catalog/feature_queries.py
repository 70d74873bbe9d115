"""Feature tables, encodings and descriptive statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from winnow.catalog.bindings import *  # noqa: F403
from winnow.catalog.bindings import R
from winnow.catalog.registry import query
from winnow.operators import features as f
from winnow.operators import profile
from winnow.sources import files

STATS = stats_ctes()
EARLY_STATS = stats_ctes(*EARLY)
INTERACTION_NAMES = list(f.INTERACTIONS)
NUMERIC = [*STAT_NAMES, *INTERACTION_NAMES]
ALL_FEATURES = f.feature_columns(TAGS)


def rounded_list(names: list[str]) -> str:
    return ", ".join(f"{R(c)} as {c}" for c in names)


def entity_stats_sql(prefix: str) -> str:
    count, mean, std, low, high = f.stat_columns(prefix)
    return (f"with {STATS} select {prefix}_id, {count}, {R(mean)} as {mean}, {R(std)} as {std}, {low}, {high} "
            f"from {prefix}_stats")


@query("user_stats", entity_stats_sql("user"))
def _(spark, sf):
    return f.entity_stats(part_of(split(spark, sf), "train"), "user_id", "user")


@query("item_stats", entity_stats_sql("item"))
def _(spark, sf):
    return f.entity_stats(part_of(split(spark, sf), "train"), "item_id", "item")


@query("cold_start_defaults", f"with {STATS} select {rounded_list(STAT_NAMES)} from defaults")
def _(spark, sf):
    return f.cold_start_defaults(part_of(split(spark, sf), "train"))


@query("cold_start_fill", f"""with {EARLY_STATS}, filled as ({filled_sql()})
select {', '.join(ROW)}, split, {rounded_list(STAT_NAMES)} from filled""")
def _(spark, sf):
    data = split(spark, sf, EARLY)
    p = parts(spark, sf, data)
    return f.attach_stats(data.select(*ROW, "split"), p.user_stats, p.item_stats, p.defaults)


@query("demographics", f"with {USERS_SQL}, {DEMOGRAPHICS_SQL} select * from demographics")
def _(spark, sf):
    return f.encode_demographics(users(spark, sf))


@query("tag_vocabulary", f"""with {ITEMS_SQL},
t as (select distinct unnest(string_split(genres, '|')) as tag from items)
select tag, 'genre_' || replace(replace(lower(tag), '-', '_'), '''', '') as column_name from t""")
def _(spark, sf):
    return f.tag_vocabulary(items(spark, sf))


@query("tag_multihot", f"with {ITEMS_SQL}, {MULTIHOT_SQL} select * from multihot")
def _(spark, sf):
    catalogue = items(spark, sf)
    return f.tag_multihot(catalogue, f.vocabulary_list(catalogue))


@query("tag_multihot_token", f"""with {ITEMS_SQL} select item_id, {', '.join(
    f"cast(list_contains(string_split(genres, '|'), '{t}') as integer) as {c}" for t, c in zip(TAGS, TAG_COLUMNS))}
from items""")
def _(spark, sf):
    catalogue = items(spark, sf)
    return f.tag_multihot(catalogue, f.vocabulary_list(catalogue), mode="token")


@query("interaction_features", f"""with {STATS}, {features_sql()}
select {', '.join(ROW)}, split, {rounded_list(INTERACTION_NAMES)} from features""")
def _(spark, sf):
    data = split(spark, sf)
    p = parts(spark, sf, data)
    keep = [*ROW, "split"]
    filled = f.attach_stats(data.select(*keep), p.user_stats, p.item_stats, p.defaults)
    return f.interaction_columns(filled).select(*keep, *f.INTERACTIONS)


MATRIX_SELECT = ", ".join(
    [*ROW, "split", rounded_list(STAT_NAMES), *f.DEMOGRAPHICS, *TAG_COLUMNS, rounded_list(INTERACTION_NAMES)]
)


def _matrix(spark, sf, ratios=(0.8, 0.1)):
    data = split(spark, sf, ratios)
    p = parts(spark, sf, data)
    return p, p.matrix(data, [*ROW, "split"])


@query("feature_matrix", f"with {STATS}, {features_sql()} select {MATRIX_SELECT} from features")
def _(spark, sf):
    return _matrix(spark, sf)[1]


@query("cold_start_rows", f"""with {EARLY_STATS}, {features_sql()}
select split, count(*) as n_rows, count(distinct user_id) as n_users, {R("avg(user_avg_rating)")} as mean_default
from features where user_rating_count = 0 group by split""")
def _(spark, sf):
    return f.cold_start_rows(_matrix(spark, sf, EARLY)[1]).groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("user_id").alias("n_users"),
        F.avg("user_avg_rating").alias("mean_default"),
    )


_U = f.stat_columns("user")


@query("leakage_checks", f"""with {EARLY_STATS}, {features_sql()},
u as (select user_id, {' or '.join(f'max({c}) - min({c}) >= 0.001' for c in _U)} as moved from features group by user_id)
select 'user_stats_equal_across_splits' as "check", count(*) filter (moved) as violations from u
union all select 'no_missing_values', count(*) filter ({' or '.join(f'{c} is null' for c in ALL_FEATURES)}) from features
union all select 'cold_users_hold_defaults', count(*) filter (f.user_rating_count = 0 and (
  {' or '.join(f'abs(f.{c} - d.{c}) > 1e-9' for c in _U)})) from features f cross join defaults d
union all select 'cold_user_rows', count(*) filter (user_rating_count = 0) from features""")
def _(spark, sf):
    p, matrix = _matrix(spark, sf, EARLY)
    return f.leakage_checks(matrix, p.defaults, p.columns)


META_SQL = " union all ".join(
    f"select 'feature_group' as section, '{g}.{c}' as name, {i} as position, cast(null as double) as value"
    for g, cols in f.feature_groups(TAGS).items() for i, c in enumerate(cols)
)


@query("feature_metadata", f"""with {STATS}
{META_SQL}
{' '.join(f"union all select 'cold_start_default', '{c}', 0, {R(c)} from defaults" for c in STAT_NAMES)}
union all select 'split_size', split, 0, cast(count(*) as double) from split group by split""")
def _(spark, sf):
    data = split(spark, sf)
    p = parts(spark, sf, data)
    sizes = data.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
    meta = files.feature_metadata(spark, f.feature_groups(p.vocabulary), p.defaults, sizes)
    path = staging_path(spark, "metadata")
    files.write_json(meta, path)
    return files.read_json(spark, path, meta.schema)


# --- sources and sinks ------------------------------------------------------

@query("src_delimited", f"with {ITEMS_SQL} select * from items")
def _(spark, sf):
    path = staging_path(spark, "items-text")
    files.write_delimited(items(spark, sf), path, encoding="ISO-8859-1")
    return files.read_delimited(spark, path, files.ITEMS, encoding="ISO-8859-1")


@query("sink_parquet_roundtrip", f"with {split_sql()} select * from split")
def _(spark, sf):
    path = staging_path(spark, "splits")
    files.write_splits(split(spark, sf), path)
    train, val, test = [files.read_split(spark, path, n).select(*ROW, F.lit(n).alias("split")) for n in ("train", "val", "test")]
    return train.unionByName(val).unionByName(test)


@query("sink_csv_roundtrip", f"""with {RATINGS_SQL}
select rating, count(*) as n_rows, {R("avg(price_cents)")} as mean_price from ratings group by rating""")
def _(spark, sf):
    table_ = ratings(spark, sf).groupBy("rating").agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg("price_cents").alias("mean_price")
    )
    path = staging_path(spark, "csv")
    files.write_csv(table_, path)
    return files.read_csv(spark, path, "rating int, n_rows long, mean_price double")


# --- descriptive statistics -------------------------------------------------

def summary_sql(entity: str, source: str, value: str) -> str:
    q = ", ".join(f"{R(f'quantile_cont({value}, {p})')} as {n}" for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")))
    return (f"select '{entity}' as entity, count({value}) as count, {R(f'avg({value})')} as mean, "
            f"{R(f'stddev_samp({value})')} as std, min({value}) as min, {q}, max({value}) as max from {source}")


@query("activity_summary", f"""with {RATINGS_SQL},
u as (select user_id, count(*) as n from ratings group by 1), i as (select item_id, count(*) as n from ratings group by 1),
p as (select user_id, count(*) as n from ratings where rating >= 4 group by 1)
{summary_sql('user_id', 'u', 'n')} union all {summary_sql('item_id', 'i', 'n')}
union all {summary_sql('user_positives', 'p', 'n')}""")
def _(spark, sf):
    data = ratings(spark, sf)
    liked = profile.activity_summary(data.where(F.col("rating") >= 4), "user_id")
    return (
        profile.activity_summary(data, "user_id").unionByName(profile.activity_summary(data, "item_id"))
        .unionByName(liked.withColumn("entity", F.lit("user_positives")))
    )


@query("rating_describe", f"with {RATINGS_SQL} {summary_sql('rating', 'ratings', 'rating')}")
def _(spark, sf):
    return profile.describe_column(ratings(spark, sf), "rating")


@query("rating_distribution", f"""with {split_sql()} select split, count(*) as n_rows, {', '.join(
    R(f'count(*) filter (rating = {v}) * 100.0 / count(*)') + f' as pct_{v}' for v in range(1, 6))}
from split group by split""")
def _(spark, sf):
    return profile.rating_distribution(split(spark, sf))


@query("demographic_shares", f"""with {USERS_SQL},
l as (select 'gender' as attribute, gender as value from users union all
  select 'age', cast(age as varchar) from users union all select 'occupation', cast(occupation as varchar) from users)
select attribute, value, count(*) as n_rows, {R("count(*) * 1.0 / sum(count(*)) over (partition by attribute)")} as share
from l group by attribute, value""")
def _(spark, sf):
    people = users(spark, sf)
    long = people.select(*[F.col(c).cast("string").alias(c) for c in ("gender", "age", "occupation")]).unpivot(
        [], ["gender", "age", "occupation"], "attribute", "value"
    )
    return profile.value_shares(long, "value", ["attribute"])


@query("tag_counts", f"""with {ITEMS_SQL}, t as (select unnest(string_split(genres, '|')) as tag from items)
select tag, count(*) as n from t group by tag""")
def _(spark, sf):
    return profile.tag_counts(items(spark, sf))


@query("tag_totals", f"""with {ITEMS_SQL}, {MULTIHOT_SQL} {' union all '.join(
    f"select '{c}' as column_name, cast(sum({c}) as bigint) as total from multihot" for c in TAG_COLUMNS)}""")
def _(spark, sf):
    catalogue = items(spark, sf)
    vocabulary = f.vocabulary_list(catalogue)
    hot = f.tag_multihot(catalogue, vocabulary)
    return profile.column_totals(hot, [c for c in hot.columns if c != "item_id"])


@query("dataset_overview", f"""with {RATINGS_SQL}
select count(*) as n_rows, count(distinct user_id) as n_users, count(distinct item_id) as n_items,
  {R("1 - count(*) / (count(distinct user_id)::double * count(distinct item_id))")} as sparsity from ratings""")
def _(spark, sf):
    return profile.dataset_overview(ratings(spark, sf))


_JOINED = ["title", "genres", "gender", "age", "occupation"]


@query("null_counts", f"""with {RATINGS_SQL}, {ITEMS_SQL}, {USERS_SQL},
j as (select * from ratings left join items using (item_id) left join users using (user_id))
{' union all '.join(f"select '{c}' as column_name, count(*) filter ({c} is null) as n_null from j" for c in [*ROW, *_JOINED])}""")
def _(spark, sf):
    joined = (
        ratings(spark, sf).join(items(spark, sf), "item_id", "left").join(users(spark, sf), "user_id", "left")
    )
    return profile.null_counts(joined, [*ROW, *_JOINED])


@query("daily_counts", f"with {RATINGS_SQL} select cast(ts as date) as day, count(*) as n_rows from ratings group by 1")
def _(spark, sf):
    return profile.daily_counts(ratings(spark, sf))


@query("daily_counts_epoch", """with s as (select cast(floor(epoch(ts)) as bigint) as seconds from events)
select cast(make_timestamp(seconds * 1000000) as date) as day, count(*) as n_rows from s group by 1""")
def _(spark, sf):
    # Whole epoch seconds, as in the raw files, converted on demand.
    ts = F.col("ts")
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    seconds = ((days * 24 + F.hour(ts)) * 60 + F.minute(ts)) * 60 + F.second(ts)
    stamped = profile.epoch_to_timestamp(table(spark, sf, "events").select(seconds.alias("seconds")), "seconds")
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("ts").cast("timestamp_ntz"))
    return profile.daily_counts(stamped.select(utc.alias("ts")))


@query("time_span", f"""with {RATINGS_SQL} select min(ts) as first_ts, max(ts) as last_ts,
  cast(date_diff('day', cast(min(ts) as date), cast(max(ts) as date)) as integer) as span_days from ratings""")
def _(spark, sf):
    return profile.time_span(ratings(spark, sf))


@query("top_items", f"""with {RATINGS_SQL}, {ITEMS_SQL},
h as (select item_id, count(*) as n_rows from ratings group by 1 order by n_rows desc, item_id limit 10)
select item_id, n_rows, title from h left join items using (item_id)""")
def _(spark, sf):
    return profile.top_items(ratings(spark, sf), items(spark, sf))


def correlation_sql(a: str, b: str) -> str:
    """Null where either side is constant."""
    return f"case when stddev_samp({a}) = 0 or stddev_samp({b}) = 0 then null else corr({a}, {b}) end"


@query("target_correlation", f"""with {STATS}, {features_sql()}, t as (select * from features where split = 'train')
{' union all '.join(f"select '{c}' as feature, {R(correlation_sql(c, 'rating'))} as correlation from t" for c in ALL_FEATURES)}""")
def _(spark, sf):
    p, matrix = _matrix(spark, sf)
    return profile.target_correlation(part_of(matrix, "train"), p.columns)


# Columns whose mutual correlation is inspected.
INSPECTED = [
    "user_rating_count", "user_avg_rating", "user_rating_std", "item_rating_count", "item_avg_rating",
    "item_rating_std", "user_item_rating_diff", "user_rating_count_norm", "item_rating_count_norm",
    "gender", "age_group", "occupation",
]
_PAIRS = [(a, b) for i, a in enumerate(INSPECTED) for b in INSPECTED[i + 1:]]


@query("correlated_pairs", f"""with {STATS}, {features_sql()}, t as (select * from features where split = 'train'),
c as ({' union all '.join(f"select '{a}' as feature_a, '{b}' as feature_b, {R(correlation_sql(a, b))} as correlation from t" for a, b in _PAIRS)})
select * from c where abs(correlation) > 0.9""")
def _(spark, sf):
    return profile.correlated_pairs(part_of(_matrix(spark, sf)[1], "train"), INSPECTED)


KEY_FEATURES = ["user_rating_count", "user_avg_rating", "item_rating_count", "item_avg_rating"]


@query("split_feature_summary", f"""with {STATS}, {features_sql()} {' union all '.join(
    f"select split, '{c}' as feature, {R(f'avg({c})')} as mean, {R(f'stddev_samp({c})')} as std from features group by split"
    for c in KEY_FEATURES)}""")
def _(spark, sf):
    return profile.split_feature_summary(_matrix(spark, sf)[1], KEY_FEATURES)
