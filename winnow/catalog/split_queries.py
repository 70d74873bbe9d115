"""Splits, ids, positives and negatives."""

from __future__ import annotations

from pyspark.sql import functions as F

from winnow.catalog.bindings import *  # noqa: F403
from winnow.catalog.bindings import R
from winnow.catalog.registry import joined_text, query
from winnow.operators import ids, splits
from winnow.operators.losses import bpr_loss, inbatch_softmax_loss, pair_scores
from winnow.sources import files

SPLIT = split_sql()
EARLY_SPLIT = split_sql(*EARLY)
NEGATIVES, DRAWS, SEED, BATCH = 4, 96, 7, 512


@query("time_split", f"with {SPLIT} select * from split")
def _(spark, sf):
    return split(spark, sf).select(*ROW, "split")


@query("min_history_filter", f"""with {SPLIT},
qualified as (select user_id from split where split = 'train' group by user_id having count(*) >= 30)
select * from split where split = 'train' or user_id in (select user_id from qualified)""")
def _(spark, sf):
    return splits.minimum_history(split(spark, sf), 30).select(*ROW, "split")


@query("min_history_retained", f"""with {SPLIT},
qualified as (select user_id from split where split = 'train' group by user_id having count(*) >= 30)
select split, count(*) as rows_before,
  count(*) filter (split = 'train' or user_id in (select user_id from qualified)) as rows_after,
  {R("count(*) filter (split = 'train' or user_id in (select user_id from qualified)) * 100.0 / count(*)")} as retained_pct
from split group by split""")
def _(spark, sf):
    data = split(spark, sf)
    return splits.retained_share(data, splits.minimum_history(data, 30))


@query("split_overlap", f"""with {EARLY_SPLIT},
u as (select split, count(distinct user_id) as n_users, count(distinct user_id) filter (
        user_id not in (select user_id from split where split = 'train')) as new_users from split group by split),
i as (select split, count(distinct item_id) as n_items, count(distinct item_id) filter (
        item_id not in (select item_id from split where split = 'train')) as new_items from split group by split),
r as (select split, count(*) as n_rows, min(ts) as first_ts, max(ts) as last_ts from split group by split)
select split, n_rows, first_ts, last_ts, new_users, n_users, new_items, n_items
from r join u using (split) join i using (split)""")
def _(spark, sf):
    return splits.split_summary(split(spark, sf, EARLY))


@query("positives", f"with {RATINGS_SQL} select * from ratings where rating >= 4")
def _(spark, sf):
    return ids.positives(ratings(spark, sf))


@query("positive_rate", f"""with {SPLIT} select split, count(*) as n_rows,
  count(*) filter (rating >= 4) as n_positives, {R("avg(case when rating >= 4 then 1.0 else 0.0 end)")} as positive_rate
from split group by split""")
def _(spark, sf):
    hit = F.col("rating") >= 4
    return split(spark, sf).groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(hit).alias("n_positives"),
        F.avg(hit.cast("double")).alias("positive_rate"),
    )


# Positives of a short history: many users and items of later rows are unmapped.
EARLY_MAPS = f"""{EARLY_SPLIT},
train_pos as (select * from split where split = 'train' and rating >= 4),
user_map as (select user_id, row_number() over (order by user_id) - 1 as user_idx from (select distinct user_id from train_pos)),
item_map as (select item_id, row_number() over (order by item_id) - 1 as item_idx from (select distinct item_id from train_pos))"""


def _early_maps(spark, sf):
    data = split(spark, sf, EARLY)
    train = ids.positives(part_of(data, "train"))
    return data, ids.id_map(train, "user_id", "user_idx"), ids.id_map(train, "item_id", "item_idx")


@query("id_map_user", f"with {EARLY_MAPS} select * from user_map")
def _(spark, sf):
    return _early_maps(spark, sf)[1]


@query("id_map_item", f"with {EARLY_MAPS} select * from item_map")
def _(spark, sf):
    return _early_maps(spark, sf)[2]


@query("id_map_verify", f"""with {EARLY_MAPS}
select count(*) as n, count(distinct item_id) as n_ids, count(distinct item_idx) as n_idx,
  min(item_idx) as min_idx, max(item_idx) as max_idx,
  count(*) = count(distinct item_id) and count(*) = count(distinct item_idx) as bijective,
  min(item_idx) = 0 and max(item_idx) = count(*) - 1 as contiguous from item_map""")
def _(spark, sf):
    return ids.verify_id_map(_early_maps(spark, sf)[2], "item_id", "item_idx")


@query("id_map_roundtrip", f"with {EARLY_MAPS} select *, true as verified from item_map")
def _(spark, sf):
    """The map written, read again and verified after that."""
    path = staging_path(spark, "id-map")
    files.save_table(_early_maps(spark, sf)[2], path)
    stored = files.read_table(spark, path)
    checks = ids.verify_id_map(stored, "item_id", "item_idx").select((F.col("bijective") & F.col("contiguous")).alias("verified"))
    return stored.join(F.broadcast(checks))  # one row


PAIRS = f"""{EARLY_MAPS},
pairs as (select user_idx, item_idx, split, order_key, line_number from split join user_map using (user_id)
  join item_map using (item_id) where rating >= 4)"""


@query("training_pairs", f"with {PAIRS} select * from pairs")
def _(spark, sf):
    data, u, i = _early_maps(spark, sf)
    return ids.training_pairs(ids.positives(data), u, i).select(
        "user_idx", "item_idx", "split", "order_key", "line_number"
    )


def _train_pairs(spark, sf):
    """Index pairs of all train positives of the usual split, with the maps."""
    train = ids.positives(part_of(split(spark, sf), "train"))
    u, i = ids.id_map(train, "user_id", "user_idx"), ids.id_map(train, "item_id", "item_idx")
    return ids.training_pairs(train, u, i), u, i


TRAIN_PAIRS = f"""{SPLIT},
train_pos as (select * from split where split = 'train' and rating >= 4),
user_map as (select user_id, row_number() over (order by user_id) - 1 as user_idx from (select distinct user_id from train_pos)),
item_map as (select item_id, row_number() over (order by item_id) - 1 as item_idx from (select distinct item_id from train_pos)),
pairs as (select * from train_pos join user_map using (user_id) join item_map using (item_id))"""


@query("user_positive_sets", f"""with {TRAIN_PAIRS},
u as (select distinct user_idx, item_idx from pairs)
select user_idx, cast(floor(item_idx / 1000) as bigint) as part, count(*) as n_items,
  string_agg(cast(item_idx as varchar), ',' order by item_idx) as items from u group by 1, 2""")
def _(spark, sf):
    sets = ids.positive_sets(_train_pairs(spark, sf)[0], user_idx="user_idx", item_idx="item_idx", chunk=1000)
    return sets.select("user_idx", "part", F.size("items").cast("long").alias("n_items"), joined_text("items").alias("items"))


@query("positives_json", f"""with {TRAIN_PAIRS},
u as (select distinct user_idx, item_idx from pairs)
select user_idx, cast(floor(item_idx / 1000) as bigint) as part,
  '{{"' || user_idx || '":[' || string_agg(cast(item_idx as varchar), ',' order by item_idx) || ']}}' as json
from u group by 1, 2""")
def _(spark, sf):
    sets = ids.positive_sets(_train_pairs(spark, sf)[0], user_idx="user_idx", item_idx="item_idx", chunk=1000)
    return ids.positive_sets_json(sets, user_idx="user_idx")


STRIDE_SQL = "(select stride from stride)"


def _stride_cte() -> str:
    # Smallest stride at or above 38.1966 % of the catalogue that is coprime to it.
    return """n_items as (select count(*) as n from item_map),
stride as (select min(s) % max(n) as stride from n_items,
  unnest(range(greatest(1, cast(floor(n * 0.381966e0) as bigint)), n + 2)) as t(s) where gcd(s, n) = 1)"""


@query("negative_samples", f"""with {TRAIN_PAIRS}, {_stride_cte()},
seen as (select distinct user_idx, item_idx from pairs),
walk as (select user_idx, item_idx, r,
  ((('0x' || substr(md5('{SEED}|' || user_idx || '|' || item_idx), 1, 8))::bigint % n) + r * {STRIDE_SQL}) % n as neg_idx
  from seen, n_items, unnest(range({DRAWS})) as t(r)),
left_over as (select w.* from walk w anti join seen s on w.user_idx = s.user_idx and w.neg_idx = s.item_idx),
ranked as (select *, row_number() over (partition by user_idx, item_idx order by r) as n from left_over)
select user_idx, item_idx, cast(n as integer) as n, neg_idx from ranked where n <= {NEGATIVES}""")
def _(spark, sf):
    pairs, _, item_map = _train_pairs(spark, sf)
    return ids.negative_samples(pairs, item_map.count(), NEGATIVES, SEED)


@query("training_batches", f"""with {TRAIN_PAIRS},
p as (select distinct user_idx, item_idx from pairs),
s as (select *, row_number() over (order by md5('{SEED}|' || user_idx || '|' || item_idx), user_idx, item_idx) - 1 as pos from p)
select user_idx, item_idx, pos, cast(floor(pos / {BATCH}) as bigint) as batch_id from s""")
def _(spark, sf):
    pairs = _train_pairs(spark, sf)[0].select("user_idx", "item_idx").distinct()
    return ids.training_batches(pairs, BATCH, SEED, "user_idx", "item_idx")


VECTOR_PAIRS = f"""{RATINGS_SQL},
p as (select distinct user_id, item_id from ratings where rating >= 4
  and user_id in (select vec_id from embeddings) and item_id in (select vec_id from embeddings)),
batches as (select *, cast(floor((row_number() over (
  order by md5('{SEED}|' || user_id || '|' || item_id), user_id, item_id) - 1) / {BATCH}) as bigint) as batch_id from p)"""


@query("inbatch_softmax_loss", f"""with {VECTOR_PAIRS},
v as (select b.*, u.embedding::double[] as uv, i.embedding::double[] as iv from batches b
  join embeddings u on b.user_id = u.vec_id join embeddings i on b.item_id = i.vec_id),
logits as (select a.batch_id, a.user_id, a.item_id, list_dot_product(a.uv, b.iv) / 0.1e0 as s,
  a.user_id = b.user_id and a.item_id = b.item_id as own from v a join v b on a.batch_id = b.batch_id),
tops as (select batch_id, user_id, item_id, max(s) as m from logits group by all),
losses as (select l.batch_id, l.user_id, l.item_id,
  max(t.m) + ln(sum(exp(l.s - t.m))) - max(case when own then s end) as loss
  from logits l join tops t using (batch_id, user_id, item_id) group by all)
select batch_id, count(*) as n_rows, {R("avg(loss)")} as loss from losses group by batch_id""")
def _(spark, sf):
    users_, items_ = user_vectors(spark, sf), item_vectors(spark, sf)
    pairs = (
        ids.positives(ratings(spark, sf)).select("user_id", "item_id").distinct()
        .join(users_.select("user_id"), "user_id", "left_semi").join(items_.select("item_id"), "item_id", "left_semi")
    )
    batches = ids.training_batches(pairs, BATCH, SEED, "user_id", "item_id")
    return inbatch_softmax_loss(batches.join(users_, "user_id").join(items_, "item_id"))


@query("bpr_loss", f"""with {RATINGS_SQL}, n_items as (select count(*) as n from embeddings),
p as (select user_id, item_id, ('0x' || substr(md5('{SEED}|' || user_id || '|' || item_id), 1, 8))::bigint % n as neg
  from ratings, n_items where rating >= 4),
s as (select list_dot_product(u.embedding::double[], i.embedding::double[]) as pos,
  list_dot_product(u.embedding::double[], j.embedding::double[]) as neg
  from p join embeddings u on user_id = u.vec_id join embeddings i on item_id = i.vec_id join embeddings j on neg = j.vec_id)
select count(*) as n_rows, {R("avg(ln(1 + exp(neg - pos)))")} as bpr_loss from s""")
def _(spark, sf):
    users_, items_ = user_vectors(spark, sf), item_vectors(spark, sf)
    n = items_.count()
    pos = pair_scores(ids.positives(ratings(spark, sf)).select("user_id", "item_id"), users_, items_, name="pos")
    drawn = pos.withColumn("neg_id", F.pmod(ids.seeded_int(SEED, "user_id", "item_id"), F.lit(n)))
    both = pair_scores(drawn, users_, items_.withColumnRenamed("item_id", "neg_id"), item="neg_id", name="neg")
    return bpr_loss(both, "pos", "neg")
