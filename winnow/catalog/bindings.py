"""The pipeline's inputs, derived from the given tables, in Spark and in SQL.

Every binding reads its tables whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.catalog.registry import TIE_SHIFT
from winnow.functions.tags import slug
from winnow.operators import splits
from winnow.operators.features import attach_stats, stat_columns
from winnow.plans.feature_table import FeatureParts, additive_score, learn
from winnow.runtime import materialize, staging_path  # noqa: F401

ORDER_KEYS = ["ts", "order_key", "line_number", "item_id", "supp_key", "price_cents"]
TIES = ["item_id", "order_key", "line_number", "supp_key", "price_cents"]
ROW = ["user_id", "item_id", "rating", "ts", "order_key", "line_number", "supp_key", "price_cents"]
EARLY = (0.05, 0.05)  # a short history leaves many users and items cold

# Tags of the item catalogue.
TAGS = [
    "ANVIL", "BLUE", "BOLT", "COLD", "ECONOMY", "GEAR", "GIZMO", "HOT", "LARGE", "MEDIUM", "NEW", "OLD",
    "PLATE", "PROMO", "RED", "RING", "ROD", "SMALL", "STANDARD", "WIDGET",
]
TAG_COLUMNS = [f"genre_{slug(t)}" for t in TAGS]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ratings(spark: SparkSession, sf: str) -> DataFrame:
    """Interactions: ordered quantities as ratings 1..5."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf, "lineitem")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"),
        (1 + F.floor((F.col("l_quantity") - 1) / 10)).cast("int").alias("rating"),
        F.col("o_orderdate").alias("ts"), F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"), F.col("l_suppkey").alias("supp_key"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("price_cents"),
    )


def items(spark: SparkSession, sf: str) -> DataFrame:
    """Catalogue."""
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"),
        F.concat_ws("|", "p_type", F.upper(F.regexp_replace("p_name", " ", "|"))).alias("genres"),
    )


def users(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles."""
    segment = F.col("c_mktsegment")
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.when(F.col("c_nationkey") < 13, "M").otherwise("F").alias("gender"),
        F.when(segment == "AUTOMOBILE", 18).when(segment == "BUILDING", 25).when(segment == "FURNITURE", 35)
        .when(segment == "HOUSEHOLD", 45).otherwise(50).alias("age"),
        F.col("c_nationkey").alias("occupation"),
    )


def split(spark: SparkSession, sf: str, ratios: tuple[float, float] = (0.8, 0.1)) -> DataFrame:
    """Interactions written once, labelled train, val or test by time.

    Files are sorted by time, which lets a range filter skip their row groups.
    """
    stored = materialize(ratings(spark, sf).sortWithinPartitions("ts"))
    return splits.time_split(stored, ORDER_KEYS, *ratios)


def part_of(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("split") == name)


def parts(spark: SparkSession, sf: str, data: DataFrame) -> FeatureParts:
    return learn(data, items(spark, sf), users(spark, sf))


def scored(spark: SparkSession, sf: str, data: DataFrame | None = None,
           of: tuple[str, ...] = ("test",)) -> DataFrame:
    """Rows with the additive prediction."""
    data = data if data is not None else split(spark, sf)
    rows = data.where(F.col("split").isin(*of))
    return additive_score(rows, parts(spark, sf, data), [*ROW, "split"])


MODELS = ["user_mean", "item_mean", "additive"]


def scored_models(spark: SparkSession, sf: str, of: tuple[str, ...] = ("test",)) -> DataFrame:
    """The same rows under three models, as one long table."""
    data = split(spark, sf)
    p = parts(spark, sf, data)
    keep = [*ROW, "split"]
    filled = attach_stats(data.where(F.col("split").isin(*of)).select(*keep), p.user_stats, p.item_stats, p.defaults)
    overall = p.defaults.select(F.col("user_avg_rating").alias("g"))  # one row
    user, item = F.col("user_avg_rating"), F.col("item_avg_rating")
    values = {"user_mean": user, "item_mean": item, "additive": user + item - F.col("g")}
    wide = filled.join(F.broadcast(overall)).select(
        *keep, *[F.round(v, 6).alias(m) for m, v in values.items()]
    )
    return wide.unpivot(keep, MODELS, "model", "prediction")


def user_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("user_id"), F.col("embedding").alias("user_vec")
    )


def item_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("item_id"), F.col("embedding").alias("item_vec")
    )


def feature_log(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", "ts", F.col("event_type").alias("feature"), "value"
    )


def drift_log(spark: SparkSession, sf: str) -> DataFrame:
    """First 80 % as baseline; the rest as online values, two features shifted."""
    log = splits.time_split(feature_log(spark, sf), ["ts", "event_id"], 0.8, 0.2)
    factor = F.when(F.col("feature") == "click", 3.0).when(F.col("feature") == "view", 1.5).otherwise(1.0)
    online = F.col("split") != "train"
    return log.select(
        "event_id", "ts", "feature", F.when(online, F.col("value") * factor).otherwise(F.col("value")).alias("value"),
        F.when(online, "online").otherwise("baseline").alias("part"),
    )


# --- the same inputs as SQL -------------------------------------------------

def R(expression: str) -> str:
    """A double rounded the way ``registry.rounded`` does it."""
    return f"(round((cast({expression} as double) + {TIE_SHIFT}) * 1e6) / 1e6 + 0e0)"


RATINGS_SQL = """ratings as (
  select o_custkey as user_id, l_partkey as item_id,
         cast(1 + floor((l_quantity - 1) / 10) as integer) as rating, o_orderdate as ts,
         l_orderkey as order_key, l_linenumber as line_number, l_suppkey as supp_key,
         cast(round(l_extendedprice * 100) as bigint) as price_cents
  from lineitem join orders on l_orderkey = o_orderkey)"""

ITEMS_SQL = """items as (
  select p_partkey as item_id, p_name as title,
         p_type || '|' || upper(replace(p_name, ' ', '|')) as genres
  from part)"""

USERS_SQL = """users as (
  select c_custkey as user_id, case when c_nationkey < 13 then 'M' else 'F' end as gender,
         case c_mktsegment when 'AUTOMOBILE' then 18 when 'BUILDING' then 25 when 'FURNITURE' then 35
              when 'HOUSEHOLD' then 45 else 50 end as age,
         c_nationkey as occupation
  from customer)"""


def split_sql(train: float = 0.8, val: float = 0.1) -> str:
    return f"""{RATINGS_SQL},
ordered as (select *, row_number() over (order by {', '.join(ORDER_KEYS)}) as rn, count(*) over () as n from ratings),
split as (select {', '.join(ROW)},
  case when rn <= floor(n * {train}::double) then 'train'
       when rn <= floor(n * ({train}::double + {val}::double)) then 'val' else 'test' end as split
  from ordered)"""


def stats_sql(source: str, key: str, prefix: str) -> str:
    count, mean, std, low, high = stat_columns(prefix)
    return (
        f"select {key}, count(rating) as {count}, avg(rating) as {mean}, "
        f"coalesce(stddev_samp(rating), 0) as {std}, min(rating) as {low}, max(rating) as {high} "
        f"from {source} group by {key}"
    )


def stats_ctes(train: float = 0.8, val: float = 0.1) -> str:
    d = []
    for p in ("user", "item"):
        count, mean, std, low, high = stat_columns(p)
        d.append(
            f"0e0 as {count}, avg(rating) as {mean}, stddev_samp(rating) as {std}, "
            f"cast(min(rating) as double) as {low}, cast(max(rating) as double) as {high}"
        )
    return f"""{split_sql(train, val)},
train as (select * from split where split = 'train'),
user_stats as ({stats_sql('train', 'user_id', 'user')}),
item_stats as ({stats_sql('train', 'item_id', 'item')}),
defaults as (select {', '.join(d)} from train)"""


STAT_NAMES = stat_columns("user") + stat_columns("item")
FILLED = ", ".join(
    f"coalesce(cast({t}.{c} as double), defaults.{c}) as {c}"
    for t, p in (("user_stats", "user"), ("item_stats", "item")) for c in stat_columns(p)
)


def filled_sql(source: str = "split", keep: list[str] | None = None) -> str:
    """``source`` rows with statistics, cold entities filled."""
    cols = ", ".join(f"s.{c}" for c in (keep or [*ROW, "split"]))
    return f"""select {cols}, {FILLED} from {source} s
  left join user_stats on s.user_id = user_stats.user_id
  left join item_stats on s.item_id = item_stats.item_id cross join defaults"""


MULTIHOT_SQL = "multihot as (select item_id, " + ", ".join(
    f"cast(contains(genres, '{t}') as integer) as {c}" for t, c in zip(TAGS, TAG_COLUMNS)
) + " from items)"

DEMOGRAPHICS_SQL = """demographics as (
  select user_id, cast(gender = 'M' as integer) as gender, age as age_group, occupation from users)"""


def features_sql(source: str = "split", keep: list[str] | None = None, age: int = 0) -> str:
    """CTE ``features`` with all features of ``source`` rows."""
    keep = keep or [*ROW, "split"]
    cols = ", ".join(f"f.{c}" for c in keep)
    tags = ", ".join(f"coalesce(multihot.{c}, 0) as {c}" for c in TAG_COLUMNS)
    stats = ", ".join(f"coalesce(f.{c}, 0) as {c}" for c in STAT_NAMES)
    return f"""{ITEMS_SQL}, {USERS_SQL}, {MULTIHOT_SQL}, {DEMOGRAPHICS_SQL},
filled as ({filled_sql(source, keep)}),
features as (select {cols}, {stats},
  coalesce(demographics.gender, 0) as gender, coalesce(demographics.age_group, {age}) as age_group,
  coalesce(demographics.occupation, 0) as occupation, {tags},
  f.user_avg_rating - f.item_avg_rating as user_item_rating_diff,
  ln(1 + f.user_rating_count) as user_rating_count_norm,
  ln(1 + f.item_rating_count) as item_rating_count_norm,
  ln(1 + f.user_rating_count) * ln(1 + f.item_rating_count) as user_item_activity_product
  from filled f left join demographics on f.user_id = demographics.user_id
  left join multihot on f.item_id = multihot.item_id)"""


def scored_sql(of: tuple[str, ...] = ("test",)) -> str:
    """CTEs up to ``scored`` with the additive prediction."""
    wanted = ", ".join(f"'{s}'" for s in of)
    return f"""{stats_ctes()},
filled as ({filled_sql()}),
scored as (select {', '.join('f.' + c for c in ROW)}, f.split,
  round(f.user_avg_rating + f.item_avg_rating - (select user_avg_rating from defaults), 6) as prediction
  from filled f where f.split in ({wanted}))"""


def models_sql(of: tuple[str, ...] = ("test",)) -> str:
    wanted = ", ".join(f"'{s}'" for s in of)
    cols = ", ".join("f." + c for c in ROW)
    one = "select {c}, f.split, '{m}' as model, round({e}, 6) as prediction from filled f where f.split in ({w})"
    exprs = {
        "user_mean": "f.user_avg_rating", "item_mean": "f.item_avg_rating",
        "additive": "f.user_avg_rating + f.item_avg_rating - (select user_avg_rating from defaults)",
    }
    body = "\n union all ".join(one.format(c=cols, m=m, e=e, w=wanted) for m, e in exprs.items())
    return f"{stats_ctes()},\nfilled as ({filled_sql()}),\nscored as ({body})"


def ndcg_sql(ks: tuple[int, ...], group: list[str] | None = None) -> str:
    """CTE ``ndcg`` per user (and group) over ``scored``."""
    g = "".join(f"{c}, " for c in (group or []))
    ties = ", ".join(TIES)
    sums = ", ".join(
        f"sum(case when p <= {k} then rating / log2(p + 1) else 0 end) as dcg_{k}, "
        f"sum(case when q <= {k} then rating / log2(q + 1) else 0 end) as idcg_{k}" for k in ks
    )
    outs = ", ".join(f"dcg_{k} / idcg_{k} as ndcg_{k}" for k in ks)
    return f"""positions as (select *,
  row_number() over (partition by {g}user_id order by prediction desc, {ties}) as p,
  row_number() over (partition by {g}user_id order by rating desc, {ties}) as q from scored),
gains as (select {g}user_id, count(*) as n_rows, {sums} from positions group by {g}user_id),
ndcg as (select {g}user_id, {outs} from gains where n_rows >= 2 and idcg_{ks[0]} > 0)"""


FEATURE_LOG_SQL = "feature_log as (select event_id, ts, event_type as feature, value from events)"

DRIFT_LOG_SQL = f"""{FEATURE_LOG_SQL},
numbered as (select *, row_number() over (order by ts, event_id) as rn, count(*) over () as n from feature_log),
drift_log as (select event_id, ts, feature,
  case when rn <= floor(n * 0.8::double) then value
       else value * case feature when 'click' then 3e0 when 'view' then 1.5e0 else 1e0 end end as value,
  case when rn <= floor(n * 0.8::double) then 'baseline' else 'online' end as part from numbered)"""
