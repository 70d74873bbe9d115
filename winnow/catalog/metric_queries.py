"""Ranking, retrieval and error metrics; model comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from winnow.catalog.bindings import *  # noqa: F403
from winnow.catalog.bindings import R
from winnow.catalog.registry import query
from winnow.operators import compare, ids, metrics
from winnow.operators.features import attach_stats
from winnow.plans.recommend import retrieve

SCORED = scored_sql()
NDCG = f"{SCORED},\n{ndcg_sql((10, 20))}"
KS = (10, 50, 100)
SEED = 7
PROBS = (0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


def _ndcg(spark, sf, ks=(10, 20)):
    return metrics.ndcg_per_user(scored(spark, sf), ks, ties=TIES)


@query("ndcg_per_user", f"with {NDCG} select user_id, {R('ndcg_10')} as ndcg_10, {R('ndcg_20')} as ndcg_20 from ndcg")
def _(spark, sf):
    return _ndcg(spark, sf)


@query("ndcg_mean", f"""with {NDCG} select count(*) as n_users, {R('coalesce(avg(ndcg_10), 0)')} as ndcg_10,
  {R('coalesce(avg(ndcg_20), 0)')} as ndcg_20 from ndcg""")
def ndcg_mean(spark, sf):
    return _ndcg(spark, sf).agg(
        F.count(F.lit(1)).alias("n_users"), F.coalesce(F.avg("ndcg_10"), F.lit(0.0)).alias("ndcg_10"),
        F.coalesce(F.avg("ndcg_20"), F.lit(0.0)).alias("ndcg_20"),
    )


def distribution_sql(source: str, value: str, probs: tuple[float, ...]) -> str:
    v = f"round({value}, 6)"
    ps = ", ".join(f"{R(f'quantile_cont({v}, {p})')} as p{round(p * 100):02d}" for p in probs)
    return (f"select count(*) as n_users, {R(f'avg({v})')} as mean, {R(f'quantile_cont({v}, 0.5)')} as median, "
            f"{R(f'stddev_samp({v})')} as std, {R(f'min({v})')} as min, {R(f'max({v})')} as max, {ps} from {source}")


@query("ndcg_distribution", f"with {NDCG} {distribution_sql('ndcg', 'ndcg_10', PROBS)}")
def _(spark, sf):
    return metrics.value_distribution(_ndcg(spark, sf, (10,)), "ndcg_10", PROBS)


def _extreme(sf_desc: bool) -> str:
    order = "desc" if sf_desc else "asc"
    return f"""with {NDCG}, r as (select user_id, round(ndcg_10, 6) as ndcg_10 from ndcg)
select user_id, {R('ndcg_10')} as ndcg_10 from r order by ndcg_10 {order}, user_id limit 10"""


@query("best_users", _extreme(True))
def _(spark, sf):
    per_user = _ndcg(spark, sf, (10,)).withColumn("ndcg_10", F.round("ndcg_10", 6))
    return per_user.orderBy(F.desc("ndcg_10"), F.asc("user_id")).limit(10)


@query("worst_users", _extreme(False))
def _(spark, sf):
    per_user = _ndcg(spark, sf, (10,)).withColumn("ndcg_10", F.round("ndcg_10", 6))
    return per_user.orderBy(F.asc("ndcg_10"), F.asc("user_id")).limit(10)


@query("ndcg_low_activity", f"""with {NDCG}, c as (select user_id, count(*) as n from scored group by 1)
select count(*) as n_users, {R('avg(ndcg_10)')} as ndcg_10 from ndcg join c using (user_id) where n <= 5""")
def _(spark, sf):
    rows = scored(spark, sf)
    few = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= 5)
    return metrics.ndcg_per_user(rows, (10,), ties=TIES).join(few, "user_id").agg(
        F.count(F.lit(1)).alias("n_users"), F.avg("ndcg_10").alias("ndcg_10")
    )


ERR = "prediction - rating"


@query("regression_metrics", f"""with {SCORED} select count(*) as n_rows,
  {R(f'sqrt(avg(({ERR}) * ({ERR})))')} as rmse, {R(f'avg(abs({ERR}))')} as mae from scored""")
def _(spark, sf):
    return metrics.regression_metrics(scored(spark, sf))


@query("error_summary", f"""with {SCORED} select {R(f'avg({ERR})')} as mean_error, {R(f'stddev_pop({ERR})')} as std_error,
  {R(f'avg(abs({ERR}))')} as mae, {R(f'min({ERR})')} as min_error, {R(f'max({ERR})')} as max_error from scored""")
def _(spark, sf):
    return metrics.error_summary(scored(spark, sf))


_RANGES = ["< -2", "[-2, -1)", "[-1, -0.5)", "[-0.5, 0)", "[0, 0.5)", "[0.5, 1)", "[1, 2)", ">= 2"]
_BUCKET = " + ".join(f"cast({ERR} >= {e} as integer)" for e in metrics.ERROR_EDGES)


@query("error_buckets", f"""with {SCORED}, names(bucket, error_range) as (values {', '.join(
    f"({i}, '{n}')" for i, n in enumerate(_RANGES))}),
c as (select {_BUCKET} as bucket, count(*) as n from scored group by 1)
select bucket, error_range, coalesce(n, 0) as n_rows, {R("coalesce(n, 0) * 100.0 / (select count(*) from scored)")} as pct
from names left join c using (bucket)""")
def _(spark, sf):
    return metrics.error_buckets(scored(spark, sf))


@query("error_by_rating", f"""with {SCORED} select rating, count(*) as n_rows, {R(f'avg({ERR})')} as mean_error,
  {R(f'avg(abs({ERR}))')} as mean_abs_error, {R(f'stddev_samp(abs({ERR}))')} as std_abs_error from scored group by rating""")
def _(spark, sf):
    return metrics.error_by_rating(scored(spark, sf))


def evaluate_sql(group: list[str]) -> str:
    """CTE ``evaluated`` with the four metrics per group over ``scored``."""
    g = "".join(f"{c}, " for c in group)
    by = f"group by {', '.join(group)}" if group else ""
    using = f"using ({', '.join(group)})" if group else "on true"
    return f"""{ndcg_sql((10, 20), group)},
errors as (select {g}count(*) as n_rows, sqrt(avg(({ERR}) * ({ERR}))) as rmse, avg(abs({ERR})) as mae from scored {by}),
means as (select {g}avg(ndcg_10) as ndcg_10, avg(ndcg_20) as ndcg_20 from ndcg {by}),
evaluated as (select {g}n_rows, rmse, mae, coalesce(ndcg_10, 0) as ndcg_10, coalesce(ndcg_20, 0) as ndcg_20
  from errors left join means {using})"""


_FOUR = ", ".join(f"{R(m)} as {m}" for m in ("rmse", "mae", "ndcg_10", "ndcg_20"))


@query("evaluate_scores", f"with {SCORED}, {evaluate_sql([])} select n_rows, {_FOUR} from evaluated")
def _(spark, sf):
    return metrics.evaluate_scores(scored(spark, sf), ties=TIES)


_LONG = "unpivot (select {k}, ndcg_10, ndcg_20, rmse, mae from evaluated) on ndcg_10, ndcg_20, rmse, mae into name metric value v"
_W = {m: f"max(case when model = '{m}' then round(v, 12) end)" for m in MODELS}


@query("compare_models", f"""with {models_sql()}, {evaluate_sql(['model'])},
l as ({_LONG.format(k='model')}),
w as (select metric, {', '.join(f'{e} as {m}' for m, e in _W.items())}, metric in ('ndcg_10', 'ndcg_20') as up from l group by metric),
t as (select *, case when up then greatest({', '.join(MODELS)}) else least({', '.join(MODELS)}) end as target,
  additive - user_mean as d from w),
b as (select *, case {' '.join(f"when {m} = target then '{m}'" for m in MODELS)} end as best_model from t)
select metric, {', '.join(f'{R(m)} as {m}' for m in MODELS)}, best_model, {R('d')} as diff,
  case when d = 0 then 'same' when (d > 0) = up then 'better' else 'worse' end as verdict,
  count(*) over (partition by best_model) as wins from b""")
def _(spark, sf):
    return compare.compare_models(scored_models(spark, sf), MODELS, ties=TIES)


@query("fit_diagnosis", f"""with {models_sql(('train', 'val'))}, {evaluate_sql(['model', 'split'])},
p as (select model, {', '.join(f"max(case when split = '{s}' then {m} end) as {s}_{m}" for m in ('ndcg_10', 'rmse') for s in ('train', 'val'))}
  from evaluated group by model),
g as (select *, train_ndcg_10 - val_ndcg_10 as ndcg_gap, val_rmse - train_rmse as rmse_gap from p)
select model, {', '.join(f'{R(c)} as {c}' for c in ('train_ndcg_10', 'val_ndcg_10', 'train_rmse', 'val_rmse', 'ndcg_gap', 'rmse_gap'))},
  case when ndcg_gap > 0.05 then 'REDUCE_COMPLEXITY' when ndcg_gap < 0.02 and val_ndcg_10 < 0.7 then 'INCREASE_COMPLEXITY'
       else 'NONE' end as action from g""")
def _(spark, sf):
    return compare.diagnose_fit(scored_models(spark, sf, ("train", "val")), group=["model"], ties=TIES)


@query("val_test_gap", f"""with {scored_sql(('val', 'test'))}, {evaluate_sql(['split'])},
l as ({_LONG.format(k='split')}),
w as (select metric, max(case when split = 'val' then v end) as val, max(case when split = 'test' then v end) as test from l group by metric)
select metric, {R('val')} as val, {R('test')} as test, {R('test - val')} as diff from w""")
def _(spark, sf):
    return compare.split_gap(scored(spark, sf, of=("val", "test")), ties=TIES)


# Runs of a sweep: shrinkage weight x evaluated split; a run fails above an error limit.
WEIGHTS = (0.0, 0.5, 1.0)
LIMIT = 1.46


def _sweep_runs(spark, sf):
    data = split(spark, sf)
    p = parts(spark, sf, data)
    rows = attach_stats(
        data.where(F.col("split") != "train").select(*ROW, "split"), p.user_stats, p.item_stats, p.defaults
    )
    overall = p.defaults.select(F.col("user_avg_rating").alias("g"))  # one row
    weights = F.explode(F.lit(list(WEIGHTS)))
    shift = F.col("user_avg_rating") + F.col("item_avg_rating") - 2 * F.col("g")
    runs = rows.join(F.broadcast(overall)).withColumn("weight", weights).withColumn(
        "prediction", F.round(F.col("g") + F.col("weight") * shift, 6)
    )
    table_ = metrics.evaluate_scores(runs, group=["weight", "split"], ties=TIES)
    return table_.withColumn("status", F.when(F.col("rmse") > LIMIT, "failed").otherwise("success"))


SWEEP = f"""{stats_ctes()}, filled as ({filled_sql()}),
scored as (select {', '.join('f.' + c for c in ROW)}, f.split, w.weight,
  round(d.user_avg_rating + w.weight * (f.user_avg_rating + f.item_avg_rating - 2 * d.user_avg_rating), 6) as prediction
  from filled f cross join defaults d, (values {', '.join(f'({w}::double)' for w in WEIGHTS)}) as w(weight) where f.split <> 'train'),
{evaluate_sql(['weight', 'split'])},
runs as (select *, case when rmse > {LIMIT} then 'failed' else 'success' end as status from evaluated)"""


@query("sweep_runs", f"with {SWEEP} select {R('weight')} as weight, split, n_rows, {_FOUR}, status from runs")
def _(spark, sf):
    return _sweep_runs(spark, sf)


@query("sweep_summary", f"""with {SWEEP} select {R('weight')} as weight, count(*) as n_runs, {', '.join(
    f"{R(f'avg({m})')} as mean_{m}, {R(f'stddev_samp({m})')} as std_{m}" for m in ('ndcg_10', 'rmse'))}
from runs where status = 'success' group by weight""")
def _(spark, sf):
    return compare.sweep_summary(_sweep_runs(spark, sf), "weight", ["ndcg_10", "rmse"])


@query("best_run", f"""with {SWEEP} select {R('weight')} as weight, split, {_FOUR} from runs where status = 'success'
order by round(ndcg_10, 6) desc, weight, split limit 1""")
def _(spark, sf):
    runs = _sweep_runs(spark, sf).withColumn("ndcg_10", F.round("ndcg_10", 6)).withColumn(
        "run_id", F.concat_ws("/", "weight", "split")
    )
    return compare.best_run(runs, "ndcg_10").select("weight", "split", "rmse", "mae", "ndcg_10", "ndcg_20")


# --- retrieval --------------------------------------------------------------

WANTED = f"""{split_sql()},
train_pos as (select distinct user_id, item_id from split where split = 'train' and rating >= 4),
item_counts as (select item_id, count(*) as n from split where split = 'train' and rating >= 4 group by 1),
wanted as (select distinct user_id, item_id from split where split = 'test' and rating >= 4
  and user_id in (select user_id from train_pos) and item_id in (select item_id from train_pos))"""
RETRIEVED = f"""sims as (select u.vec_id as user_id, i.vec_id as item_id,
  round(list_dot_product(u.embedding::double[], i.embedding::double[]), 6) as similarity
  from embeddings u cross join embeddings i),
ranked as (select *, row_number() over (partition by user_id order by similarity desc, item_id) as rank from sims)"""


def recall_cte(ranks: str, name: str = "recall") -> str:
    rs = ", ".join(f"count(*) filter (rank <= {k}) * 1e0 / count(*) as recall_{k}" for k in KS)
    return f"{name} as (select user_id, count(*) as n_positives, {rs} from ({ranks}) group by user_id)"


MODEL_RECALL = f"{WANTED}, {RETRIEVED}, {recall_cte('select w.*, r.rank from wanted w left join ranked r using (user_id, item_id)')}"
POPULAR = "popular as (select item_id, row_number() over (order by n desc, item_id) as rank from item_counts)"
POPULAR_RECALL = recall_cte("select w.*, p.rank from wanted w left join popular p using (item_id)", "popular_recall")
_HASH = f"('0x' || substr(md5('{SEED}|' || user_id), 1, 8))::bigint"
RANDOM = f"""item_map as (select item_id, row_number() over (order by item_id) - 1 as item_idx from item_counts),
size as (select count(*) as n from item_map),
bases as (select j, n, greatest(1, cast(floor(n * (0.381966::double + 0.05::double * j)) as bigint)) as base
  from size, unnest(range(8)) as t(j)),
strides as (select j, min(n) as n, min(s) % min(n) as stride from bases, unnest(range(base, base + 200)) as t(s)
  where gcd(s, n) = 1 group by j),
inverses as (select j, min(r) as inverse from strides, unnest(range(n)) as t(r) where (r * stride) % n = 1 group by j)"""
RANDOM_RECALL = recall_cte(
    f"""select user_id, item_id, ((((item_idx - {_HASH} % n) % n + n) % n) * inverse) % n + 1 as rank
  from wanted join item_map using (item_id) cross join size join inverses on j = {_HASH} % 8""", "random_recall")
MEANS = ", ".join(f"{R(f'avg(recall_{k})')} as recall_{k}" for k in KS)
PER_USER = ", ".join(f"{R(f'recall_{k}')} as recall_{k}" for k in KS)


def _wanted(spark, sf):
    data = split(spark, sf)
    train = ids.positives(part_of(data, "train"))
    test = ids.positives(part_of(data, "test"))
    # Stored, so that rows of hot users and items can be split in the joins.
    known = test.join(materialize(train.select("user_id").distinct(), "users"), "user_id", "left_semi").join(
        materialize(train.select("item_id").distinct(), "items"), "item_id", "left_semi"
    )
    return train, known.select("user_id", "item_id").distinct()


def _model_recall(spark, sf, wanted=None):
    wanted = wanted if wanted is not None else _wanted(spark, sf)[1]
    found = retrieve(user_vectors(spark, sf), item_vectors(spark, sf), max(KS))
    return metrics.recall_per_user(
        found.select("user_id", "item_id", F.col("retrieval_rank").alias("rank")), wanted, KS
    )


def _random_recall(train, wanted):
    item_map = ids.id_map(train, "item_id", "item_idx")
    ranked = ids.random_rank(
        wanted.join(item_map, "item_id"), item_map.count(), SEED, user="user_id", item_idx="item_idx"
    )
    return metrics.recall_from_ranks(ranked, KS)


@query("recall_per_user", f"with {MODEL_RECALL} select user_id, n_positives, {PER_USER} from recall")
def _(spark, sf):
    return _model_recall(spark, sf)


@query("recall_at_k", f"with {MODEL_RECALL} select count(*) as n_users, {MEANS} from recall")
def _(spark, sf):
    return metrics.mean_recall(_model_recall(spark, sf), KS)


@query("recall_distribution", f"with {MODEL_RECALL} {distribution_sql('recall', 'recall_50', PROBS)}")
def _(spark, sf):
    return metrics.value_distribution(_model_recall(spark, sf), "recall_50", PROBS)


@query("recall_by_activity", f"""with {MODEL_RECALL} select case when n_positives <= 5 then '1-5' when n_positives <= 10 then '6-10'
  when n_positives <= 20 then '11-20' when n_positives <= 50 then '21-50' else '50+' end as activity,
  count(*) as n_users, {R('avg(recall_50)')} as recall_50 from recall group by 1""")
def _(spark, sf):
    return metrics.recall_by_activity(_model_recall(spark, sf), 50)


@query("popularity", f"""with {WANTED} select item_id, n as n_positives,
  cast(row_number() over (order by n desc, item_id) as integer) as rank from item_counts order by rank limit 100""")
def _(spark, sf):
    return metrics.popularity(ids.positives(part_of(split(spark, sf), "train")), 100)


@query("popularity_recall", f"with {WANTED}, {POPULAR}, {POPULAR_RECALL} select count(*) as n_users, {MEANS} from popular_recall")
def _(spark, sf):
    train, wanted = _wanted(spark, sf)
    return metrics.mean_recall(metrics.popularity_recall(train, wanted, KS), KS)


@query("random_recall", f"with {WANTED}, {RANDOM}, {RANDOM_RECALL} select count(*) as n_users, {MEANS} from random_recall")
def _(spark, sf):
    return metrics.mean_recall(_random_recall(*_wanted(spark, sf)), KS)


def _lift_row(k: int) -> str:
    m, p, r = (f"(select avg(recall_{k}) from {t})" for t in ("recall", "popular_recall", "random_recall"))
    return (f"select 'recall_{k}' as metric, {R(m)} as model, {R(p)} as popularity, {R(r)} as random, "
            f"{R(f'({m} / nullif({p}, 0) - 1) * 100')} as lift_pct")


@query("recall_lift", f"with {MODEL_RECALL}, {POPULAR}, {POPULAR_RECALL}, {RANDOM}, {RANDOM_RECALL} "
       + " union all ".join(_lift_row(k) for k in KS))
def _(spark, sf):
    train, wanted = _wanted(spark, sf)
    wanted = materialize(wanted)  # read by three recommenders
    tables = {
        "model": _model_recall(spark, sf, wanted),
        "popularity": metrics.popularity_recall(train, wanted, KS),
        "random": _random_recall(train, wanted),
    }
    return metrics.lift({n: metrics.mean_recall(t, KS) for n, t in tables.items()}, KS, "popularity")
