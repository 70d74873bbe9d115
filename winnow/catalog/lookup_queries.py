"""Key/value snapshots and layered lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from winnow.catalog.bindings import *  # noqa: F403
from winnow.catalog.bindings import R
from winnow.catalog.registry import query
from winnow.operators import features as f
from winnow.operators import kv_store
from winnow.operators import lookup_tables as kv

STATS = f"{stats_ctes(*EARLY)}, {ITEMS_SQL}, {USERS_SQL}, {MULTIHOT_SQL}, {DEMOGRAPHICS_SQL}"
DEMO = list(f.DEMOGRAPHICS)


def _kv_sql(source: str, entity: str, group: str, fields: list[str]) -> str:
    return " union all ".join(
        f"select 'features:{entity}:' || {entity}_id || ':{group}' as key, '{c}' as field, cast({c} as double) as value from {source}"
        for c in fields
    )


USER_KV = f"""user_kv as ({_kv_sql('user_stats', 'user', 'stats', f.stat_columns('user'))}
  union all {_kv_sql('demographics', 'user', 'demographics', DEMO)})"""
ITEM_KV = f"""item_kv as ({_kv_sql('item_stats', 'item', 'stats', f.stat_columns('item'))}
  union all {_kv_sql('multihot', 'item', 'genres', TAG_COLUMNS)})"""


def _parts(spark, sf):
    return parts(spark, sf, split(spark, sf, EARLY))


def _user_kv(p):
    return kv.to_key_value(p.user_stats, "user", "user_id", "stats", f.stat_columns("user")).unionByName(
        kv.to_key_value(p.demographics, "user", "user_id", "demographics", DEMO)
    )


def _item_kv(p):
    return kv.to_key_value(p.item_stats, "item", "item_id", "stats", f.stat_columns("item")).unionByName(
        kv.to_key_value(p.multihot, "item", "item_id", "genres", [c for c in p.multihot.columns if c != "item_id"])
    )


def _published(spark, snapshot):
    path = staging_path(spark, "kv")
    kv.publish(snapshot, path)
    return spark.read.parquet(path)


@query("publish_kv_user", f"with {STATS}, {USER_KV} select key, field, {R('value')} as value from user_kv")
def _(spark, sf):
    return _published(spark, _user_kv(_parts(spark, sf))).select("key", "field", "value")


@query("publish_kv_item", f"with {STATS}, {ITEM_KV} select key, field, {R('value')} as value from item_kv")
def _(spark, sf):
    return _published(spark, _item_kv(_parts(spark, sf))).select("key", "field", "value")


# The usual split's statistics arrive as a newer version over the early ones.
LATE_USERS = f"late_user as ({stats_sql('late_train', 'user_id', 'user')})"
UPSERT = f"""{STATS}, late_train as (select s.* from (
  select *, row_number() over (order by {', '.join(ORDER_KEYS)}) as rn, count(*) over () as n from ratings) s
  where rn <= floor(n * 0.8::double)), {LATE_USERS},
old as ({_kv_sql('user_stats', 'user', 'stats', f.stat_columns('user'))}),
new as ({_kv_sql('late_user', 'user', 'stats', f.stat_columns('user'))})"""


@query("kv_upsert", f"""with {UPSERT}
select coalesce(new.key, old.key) as key, coalesce(new.field, old.field) as field,
  {R('case when new.key is not null then new.value else old.value end')} as value,
  case when new.key is not null then 2 else 1 end as version
from old full join new on old.key = new.key and old.field = new.field""")
def _(spark, sf):
    def stats(ratios, version):
        train = part_of(split(spark, sf, ratios), "train")
        rows = f.entity_stats(train, "user_id", "user")
        return kv.to_key_value(rows, "user", "user_id", "stats", f.stat_columns("user")).withColumn(
            "version", F.lit(version)
        )

    return kv.upsert(stats(EARLY, 1), stats((0.8, 0.1), 2))


@query("kv_reconcile", f"""with {UPSERT}
select count(*) as n_values, count(*) filter (old.key is null) as n_missing,
  count(*) filter (old.key is not null and abs(new.value - old.value) > 0.001) as n_different
from new left join old on old.key = new.key and old.field = new.field""")
def _(spark, sf):
    # A stale snapshot is checked against newer statistics, so differences exist.
    def stats(ratios):
        rows = f.entity_stats(part_of(split(spark, sf, ratios), "train"), "user_id", "user")
        return kv.to_key_value(rows, "user", "user_id", "stats", f.stat_columns("user"))

    return kv.reconcile(stats((0.8, 0.1)), _published(spark, stats(EARLY)))


@query("kv_key_counts", f"""with {STATS}, {USER_KV}, {ITEM_KV},
k as (select distinct key from (select key from user_kv union all select key from item_kv))
select split_part(key, ':', 2) || '_' || split_part(key, ':', 4) as kind, count(*) as n_keys from k group by 1""")
def _(spark, sf):
    p = _parts(spark, sf)
    return kv.key_counts(_published(spark, _user_kv(p).unionByName(_item_kv(p))))


# --- lookups ----------------------------------------------------------------

_US, _IS = f.stat_columns("user"), f.stat_columns("item")
LOOKUP_USER = f"""req as (select c_custkey as user_id from customer),
looked as (select r.user_id, {', '.join(f'case when s.user_id is null then d.{c} else cast(s.{c} as double) end as {c}' for c in _US)},
  case when s.user_id is null then 'fallback' else 'primary' end as source
  from req r left join user_stats s on r.user_id = s.user_id cross join defaults d)"""


def _user_lookup(spark, sf):
    p = _parts(spark, sf)
    requests = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return kv.layered_lookup(requests, p.user_stats, "user_id", p.defaults)


@query("lookup_user_features", f"""with {STATS}, {LOOKUP_USER}
select user_id, {', '.join(f'{R(c)} as {c}' for c in _US)}, source from looked""")
def _(spark, sf):
    return _user_lookup(spark, sf)


@query("lookup_user_demographics", f"""with {USERS_SQL}, {DEMOGRAPHICS_SQL}
select c_custkey as user_id, {', '.join(f"cast(coalesce(d.{c}, {v}) as double) as {c}" for c, v in f.SERVING_DEMOGRAPHICS.items())},
  case when d.user_id is null then 'fallback' else 'primary' end as source
from customer left join demographics d on c_custkey = d.user_id""")
def _(spark, sf):
    requests = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return kv.layered_lookup(
        requests, f.encode_demographics(users(spark, sf)), "user_id", f.SERVING_DEMOGRAPHICS
    )


@query("lookup_item_features", f"""with {STATS}
select p_partkey as item_id, {', '.join(R(f'case when s.item_id is null then d.{c} else s.{c} end') + f' as {c}' for c in _IS)},
  case when s.item_id is null then 'fallback' else 'primary' end as source
from part left join item_stats s on p_partkey = s.item_id cross join defaults d""")
def _(spark, sf):
    requests = table(spark, sf, "part").select(F.col("p_partkey").alias("item_id"))
    p = _parts(spark, sf)
    return kv.layered_lookup(requests, p.item_stats, "item_id", p.defaults)


@query("user_feature_map", f"""with {STATS}, {LOOKUP_USER}
{' union all '.join(f"select user_id, source, '{c}' as name, {R(c)} as value from looked" for c in _US)}""")
def _(spark, sf):
    as_map = kv.features_as_map(_user_lookup(spark, sf), "user_id", _US)
    return as_map.select("user_id", "source", F.explode("features").alias("name", "value"))


@query("lookup_stats", f"""with {STATS}, {LOOKUP_USER}
select count(*) as total_requests, count(*) filter (source = 'primary') as hits, count(*) filter (source = 'fallback') as misses,
  {R("count(*) filter (source = 'primary') / count(*)")} as hit_rate, {R("count(*) filter (source = 'fallback') / count(*)")} as fallback_rate
from looked""")
def _(spark, sf):
    return kv.lookup_stats(_user_lookup(spark, sf))


# The event table read as a log of lookups: its values are latencies.
@query("lookup_log_stats", f"""with log as (select case when event_type in ('click', 'view') then 'primary'
  when event_type = 'purchase' then 'fallback' else 'error' end as source, value as latency_ms from events)
select count(*) as total_requests, count(*) filter (source = 'primary') as hits, count(*) filter (source = 'fallback') as misses,
  count(*) filter (source = 'error') as errors, {R("count(*) filter (source = 'primary') / count(*)")} as hit_rate,
  {R("count(*) filter (source = 'error') / count(*)")} as error_rate, {R("coalesce(avg(latency_ms), 0)")} as mean_latency_ms from log""")
def _(spark, sf):
    kind = F.col("event_type")
    source = F.when(kind.isin("click", "view"), "primary").when(kind == "purchase", "fallback").otherwise("error")
    return kv.lookup_log_stats(table(spark, sf, "events").select(source.alias("source"), F.col("value").alias("latency_ms")))


def _stats_kv(spark, sf, ratios):
    rows = f.entity_stats(part_of(split(spark, sf, ratios), "train"), "user_id", "user")
    return kv.to_key_value(rows, "user", "user_id", "stats", f.stat_columns("user"))


# The early statistics published into a bucketed store, the later ones upserted into it by copy-on-write.
@query("kv_store_upsert", f"""with {UPSERT}
select coalesce(new.key, old.key) as key, coalesce(new.field, old.field) as field,
  {R('case when new.key is not null then new.value else old.value end')} as value
from old full join new on old.key = new.key and old.field = new.field""")
def _(spark, sf):
    store = kv_store.BucketedStore(spark, staging_path(spark, "kv-store"))
    store.publish(_stats_kv(spark, sf, EARLY))
    store.upsert(_stats_kv(spark, sf, (0.8, 0.1)))
    return store.read()


# Every customer's statistics looked up in the store, reading only the buckets of the requested keys.
@query("kv_store_lookup", f"""with {STATS}, {USER_KV}
select key, field, {R('value')} as value from user_kv
where key in (select 'features:user:' || c_custkey || ':stats' from customer)""")
def _(spark, sf):
    store = kv_store.BucketedStore(spark, staging_path(spark, "kv-store"))
    store.publish(_user_kv(_parts(spark, sf)))
    requests = table(spark, sf, "customer").select(F.format_string("features:user:%s:stats", F.col("c_custkey").cast("string")).alias("key"))
    return store.lookup(requests)

