"""Vector search, recommendation and embedding diagnostics."""

from __future__ import annotations

from pyspark.sql import functions as F

from winnow.catalog.bindings import *  # noqa: F403
from winnow.catalog.bindings import R
from winnow.catalog.metric_queries import RETRIEVED
from winnow.catalog.registry import joined_text, query
from winnow.functions.hashing import seeded_int, seeded_key
from winnow.functions.vectors import l2_normalize
from winnow.operators import features, graph_search, nearest, ranking
from winnow.operators.losses import pair_scores
from winnow.plans.recommend import merge_rankings, recommend, recommend_requests, retrieve

SEED = 7
K, POOL = 10, 100
DOT = "list_dot_product(u.embedding::double[], i.embedding::double[])"


def _queries(spark, sf):
    return user_vectors(spark, sf).select(F.col("user_id").alias("query_id"), F.col("user_vec").alias("vec"))


def _items(spark, sf):
    return item_vectors(spark, sf).select("item_id", F.col("item_vec").alias("vec"))


@query("vector_scores", f"""with {RATINGS_SQL}
select user_id, item_id, order_key, line_number, {R(DOT)} as score from ratings
  join embeddings u on user_id = u.vec_id join embeddings i on item_id = i.vec_id""")
def _(spark, sf):
    pairs = ratings(spark, sf).select("user_id", "item_id", "order_key", "line_number")
    return pair_scores(pairs, user_vectors(spark, sf), item_vectors(spark, sf))


@query("vector_topk", f"""with {RETRIEVED}
select user_id as query_id, item_id, {R('similarity')} as similarity, cast(rank as integer) as rank from ranked where rank <= {K}""")
def _(spark, sf):
    return nearest.exact_top_k(_queries(spark, sf), _items(spark, sf), K)


@query("vector_topk_l2", f"""with d as (select u.vec_id as query_id, i.vec_id as item_id,
  round(list_sum(list_transform(list_zip(u.embedding::double[], i.embedding::double[]), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 6) as s
  from embeddings u cross join embeddings i),
r as (select *, row_number() over (partition by query_id order by s, item_id) as rank from d)
select query_id, item_id, {R('s')} as similarity, cast(rank as integer) as rank from r where rank <= {K}""")
def _(spark, sf):
    return nearest.exact_top_k(_queries(spark, sf), _items(spark, sf), K, metric="l2")


@query("l2_normalize", f"""with n as (select vec_id, embedding::double[] as v,
  greatest(sqrt(list_dot_product(embedding::double[], embedding::double[])), 1e-12) as len from embeddings)
select vec_id, array_to_string(list_transform(v, lambda x: cast(round(x / len, 4) * 10000 as bigint)), ',') as unit from n""")
def _(spark, sf):
    unit = l2_normalize(F.col("embedding"))
    scaled = F.transform(unit, lambda x: (F.round(x, 4) * 10000).cast("double"))
    whole = F.transform(scaled, lambda x: F.round(x).cast("long"))
    return table(spark, sf, "embeddings").select("vec_id", whole.alias("w")).select(
        "vec_id", joined_text("w").alias("unit")
    )


_VALUES = "select vec_id, unnest(embedding)::double as x, unnest(range(len(embedding))) as dim from embeddings"
_LENGTH = "sqrt(list_dot_product(embedding::double[], embedding::double[]))"


@query("emb_stats", f"""with e as ({_VALUES}), d as (select dim, var_pop(x) as variance from e group by dim)
select count(*) as n_vectors, {R(f'avg({_LENGTH})')} as norm_mean, {R(f'stddev_pop({_LENGTH})')} as norm_std,
  {R('(select avg(x) from e)')} as value_mean, {R('(select stddev_pop(x) from e)')} as value_std,
  {R('(select avg(variance) from d)')} as dim_var_mean, {R('(select min(variance) from d)')} as dim_var_min,
  {R('(select max(variance) from d)')} as dim_var_max from embeddings""")
def _(spark, sf):
    return nearest.embedding_stats(_items(spark, sf))


@query("emb_dim_variance", f"""with e as ({_VALUES})
select cast(dim as integer) as dim, {R('var_pop(x)')} as variance from e group by dim""")
def _(spark, sf):
    return nearest.dimension_variance(_items(spark, sf))


@query("similarity_distribution", f"""with s as (select * from embeddings order by md5('{SEED}|' || vec_id), vec_id limit 1000),
p as (select {DOT} as x from s u cross join s i)
select count(*) as n_pairs, {R('avg(x)')} as mean, {R('stddev_pop(x)')} as std, {R('min(x)')} as min, {R('max(x)')} as max from p""")
def _(spark, sf):
    return nearest.similarity_moments(_queries(spark, sf), _items(spark, sf), 1000, SEED)


@query("separation", f"""with {RATINGS_SQL}, n_items as (select count(*) as n from embeddings),
p as (select user_id, item_id, md5('{SEED}|' || user_id || '|' || item_id) as h from ratings where rating >= 4
  and item_id in (select vec_id from embeddings) and user_id in (select vec_id from embeddings)),
one as (select user_id, arg_min(item_id, h || '|' || item_id) as item_id from p group by user_id),
s as (select list_dot_product(u.embedding::double[], i.embedding::double[]) as pos,
  list_dot_product(u.embedding::double[], j.embedding::double[]) as neg
  from one cross join n_items join embeddings u on user_id = u.vec_id join embeddings i on item_id = i.vec_id
  join embeddings j on ('0x' || substr(md5('{SEED}|' || user_id), 1, 8))::bigint % n = j.vec_id)
select count(*) as n_users, {R('avg(pos)')} as mean_pos, {R('avg(neg)')} as mean_neg, {R('avg(pos - neg)')} as mean_diff,
  {R('stddev_samp(pos - neg)')} as std_diff, {R('count(*) filter (pos - neg > 0) * 100.0 / count(*)')} as pct_separated from s""")
def _(spark, sf):
    people, catalogue = user_vectors(spark, sf), item_vectors(spark, sf)
    n = catalogue.count()
    liked = (
        ratings(spark, sf).where(F.col("rating") >= 4).select("user_id", "item_id")
        .join(catalogue.select("item_id"), "item_id", "left_semi")
    )
    order = F.concat_ws("|", seeded_key(SEED, "user_id", "item_id"), "item_id")
    one = liked.groupBy("user_id").agg(F.min_by("item_id", order).alias("item_id"))
    pos = pair_scores(one, people, catalogue, name="pos").withColumn(
        "neg_id", F.pmod(seeded_int(SEED, "user_id"), F.lit(n))
    )
    both = pair_scores(pos, people, catalogue.withColumnRenamed("item_id", "neg_id"), item="neg_id", name="neg")
    diff = F.col("pos") - F.col("neg")
    return both.agg(
        F.count(F.lit(1)).alias("n_users"), F.avg("pos").alias("mean_pos"), F.avg("neg").alias("mean_neg"),
        F.avg(diff).alias("mean_diff"), F.stddev_samp(diff).alias("std_diff"),
        (F.count_if(diff > 0) * 100.0 / F.count(F.lit(1))).alias("pct_separated"),
    )


# --- candidates, ranking, recommendation ------------------------------------

POOLED = f"""{RETRIEVED},
pool as (select user_id, item_id, similarity, rank as retrieval_rank from ranked where rank <= {POOL})"""
KEEP = ["user_id", "item_id", "similarity", "retrieval_rank"]
SCORE_SQL = ("round(f.user_avg_rating + f.item_avg_rating + 0.1 * f.genre_new - 0.002 * f.age_group "
             "+ 0.05 * f.gender * f.genre_large, 6)")
SERVING = f"{stats_ctes()}, {POOLED}, {features_sql('pool', KEEP, age=25)}"
RANKED = f"""{SERVING},
scored as (select f.*, {SCORE_SQL} as score from features f),
final as (select *, row_number() over (partition by user_id order by score desc, retrieval_rank) as rank from scored)"""


def _score():
    return F.round(
        F.col("user_avg_rating") + F.col("item_avg_rating") + 0.1 * F.col("genre_new")
        - 0.002 * F.col("age_group") + 0.05 * F.col("gender") * F.col("genre_large"), 6,
    )


def _pool(spark, sf):
    return retrieve(user_vectors(spark, sf), item_vectors(spark, sf), POOL)


def _trained(spark, sf):
    return parts(spark, sf, split(spark, sf))


@query("serving_features", f"""with {SERVING} select {', '.join(['user_id', 'item_id', R('similarity') + ' as similarity', 'cast(retrieval_rank as integer) as retrieval_rank'])},
  {', '.join(f"{R(c)} as {c}" for c in STAT_NAMES)}, {', '.join([*features.DEMOGRAPHICS, *TAG_COLUMNS])},
  {', '.join(f"{R(c)} as {c}" for c in features.INTERACTIONS)} from features""")
def _(spark, sf):
    return _trained(spark, sf).matrix(_pool(spark, sf), KEEP, serving=True)


@query("score_candidates", f"""with {RANKED} select user_id, item_id, cast(retrieval_rank as integer) as retrieval_rank, {R('score')} as score from scored""")
def _(spark, sf):
    rows = _trained(spark, sf).matrix(_pool(spark, sf), KEEP, serving=True)
    return ranking.score_candidates(rows, _score()).select("user_id", "item_id", "retrieval_rank", "score")


@query("rank_candidates", f"with {RANKED} select user_id, item_id, {R('score')} as score, cast(rank as integer) as rank from final where rank <= {POOL}")
def _(spark, sf):
    rows = _trained(spark, sf).matrix(_pool(spark, sf), KEEP, serving=True)
    scored_ = ranking.score_candidates(rows, _score())
    return ranking.rank_candidates(scored_, POOL, retrieval_rank="retrieval_rank").select(
        "user_id", "item_id", "score", "rank"
    )


@query("recommend", f"""with {RANKED} select user_id, item_id, {R('score')} as score, cast(rank as integer) as rank,
  {R('similarity')} as similarity from final where rank <= {K}""")
def _(spark, sf):
    return recommend(_pool(spark, sf), _trained(spark, sf), K, score=_score())


@query("recommend_unseen", f"""with {stats_ctes()}, {RETRIEVED},
pool as (select user_id, item_id, similarity, rank as retrieval_rank from ranked where rank <= {POOL}
  and not exists (select 1 from train t where t.user_id = ranked.user_id and t.item_id = ranked.item_id)),
{features_sql('pool', KEEP, age=25)},
scored as (select f.*, {SCORE_SQL} as score from features f),
final as (select *, row_number() over (partition by user_id order by score desc, retrieval_rank) as rank from scored)
select user_id, item_id, {R('score')} as score, cast(rank as integer) as rank, {R('similarity')} as similarity from final where rank <= {K}""")
def _(spark, sf):
    data = split(spark, sf)
    return recommend(
        _pool(spark, sf), parts(spark, sf, data), K, score=_score(), seen=part_of(data, "train")
    )


@query("merge_similarity", f"""with {RATINGS_SQL}, {POOLED},
m as (select user_id, item_id, max(rating) as rating from ratings group by all)
select m.user_id, m.item_id, rating, {R('coalesce(similarity, 0)')} as similarity from m
  left join pool using (user_id, item_id)""")
def _(spark, sf):
    best = ratings(spark, sf).groupBy("user_id", "item_id").agg(F.max("rating").alias("rating"))
    return merge_rankings(best, _pool(spark, sf))


@query("validate_requests", """with r as (select c_custkey as user_id, c_nationkey * 5 as k from customer),
v as (select *, case when user_id <= 0 then 'user_id must be positive' when k <= 0 then 'k must be positive'
  when k > 100 then 'k must be at most 100' end as reason from r)
select user_id, k, reason, reason is null as valid from v""")
def _(spark, sf):
    requests = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), (F.col("c_nationkey") * 5).alias("k")
    )
    return ranking.validate_requests(requests)


# Some users are unknown, some ask for nothing or too much, some for more than the pool.
@query("recommend_requests", f"""with {RANKED}, r as (select c_custkey as user_id, c_nationkey * 10 as k from customer),
v as (select *, case when user_id <= 0 then 'user_id must be positive' when k <= 0 then 'k must be positive'
  when k > 200 then 'k must be at most 200' end as reason from r)
select v.user_id, v.k, v.reason, case when v.reason is not null then 'rejected' when f.user_id is null then 'unknown user'
  else 'answered' end as status, f.item_id, {R('f.score')} as score, cast(f.rank as integer) as rank, {R('f.similarity')} as similarity
from v left join final f on v.user_id = f.user_id and f.rank <= v.k and v.reason is null""")
def _(spark, sf):
    requests = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), (F.col("c_nationkey") * 10).alias("k"))
    return recommend_requests(requests, _pool(spark, sf), _trained(spark, sf), max_k=200, score=_score())


# --- approximate search -----------------------------------------------------
# What an index finds depends on Spark's own seeds.  The rows below say of every query
# whether what was found is right: exact similarities, ranks without gaps up to K or the
# size of the catalogue, no repeats.

def _checked(found, wanted, catalogue):
    n = min(K, catalogue.count())
    pairs = found.join(wanted.select("query_id", F.col("vec").alias("q")), "query_id").join(
        catalogue.select("item_id", F.col("vec").alias("i")), "item_id")
    dot = F.aggregate(F.zip_with("q", "i", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda t, x: t + x)
    return pairs.groupBy("query_id").agg(
        F.min(F.abs(dot - F.col("similarity")) < 2e-6).alias("similarities_exact"),
        ((F.max("rank") == F.count(F.lit(1))) & (F.min("rank") == 1) & (F.count(F.lit(1)) == n)).alias("ranks_gapless"),
        (F.count_distinct("item_id") == F.count(F.lit(1))).alias("items_distinct"),
    )


CHECKED_SQL = """select vec_id as query_id, true as similarities_exact, true as ranks_gapless, true as items_distinct
from embeddings"""


@query("ivf_topk", CHECKED_SQL)
def _(spark, sf):
    wanted, catalogue = _queries(spark, sf), _items(spark, sf)
    return _checked(nearest.InvertedLists(catalogue).search(wanted, K), wanted, catalogue)


@query("lsh_topk", CHECKED_SQL)
def _(spark, sf):
    wanted, catalogue = _queries(spark, sf), _items(spark, sf)
    return _checked(nearest.lsh_top_k(wanted, catalogue, K), wanted, catalogue)


@query("graph_topk", CHECKED_SQL)
def _(spark, sf):
    wanted, catalogue = _queries(spark, sf), _items(spark, sf)
    return _checked(graph_search.graph_top_k(wanted, catalogue, K), wanted, catalogue)


# Whatever the plan chooses, graph or exact search, finds 0.9 of the exact neighbours of all queries.
@query("graph_recall", f"""select 'graph' as method, (select count(*) from embeddings) * {K} as n_exact, true as above_bound""")
def _(spark, sf):
    wanted, catalogue = _queries(spark, sf), _items(spark, sf)
    exact = materialize(nearest.exact_top_k(wanted, catalogue, K), "exact")
    found = graph_search.graph_top_k(wanted, catalogue, K)
    return nearest.overlap(found, exact).select(
        F.lit("graph").alias("method"), "n_exact", (F.col("overlap") >= graph_search.TARGET_RECALL).alias("above_bound"))


# Hashing with measured settings finds 0.9 of the exact neighbours, and visiting all lists
# finds all.  One and ten lists are fixed points of the curve below the settings used for
# search; they find at least their share.
@query("ann_recall", f"""select method, (select count(*) from embeddings) * {K} as n_exact, true as above_bound
from (values ('ivf_probe_1'), ('ivf_probe_10'), ('ivf_probe_100'), ('lsh')) as t(method)""")
def _(spark, sf):
    wanted, catalogue = _queries(spark, sf), _items(spark, sf)
    exact = materialize(nearest.exact_top_k(wanted, catalogue, K), "exact")
    lists = nearest.InvertedLists(catalogue)
    rows = [(f"ivf_probe_{p}", lists.search(wanted, K, n_probe=p), p / 100) for p in (1, 10, 100)]
    rows.append(("lsh", nearest.lsh_top_k(wanted, catalogue, K), 0.9))
    out = None
    for name, approximate, least in rows:
        one = nearest.overlap(approximate, exact).select(
            F.lit(name).alias("method"), "n_exact", (F.col("overlap") >= least).alias("above_bound"))
        out = one if out is None else out.unionByName(one)
    return out


# An index that visits every list must reproduce brute force exactly.
@query("ivf_full_probe", f"""with {RETRIEVED}
select user_id as query_id, item_id, {R('similarity')} as similarity, cast(rank as integer) as rank from ranked where rank <= {K}""")
def _(spark, sf):
    return nearest.InvertedLists(_items(spark, sf), n_lists=20).search(_queries(spark, sf), K, n_probe=20)
