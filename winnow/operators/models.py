"""Fitting and tuning with Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import product

from pyspark import keyword_only
from pyspark.errors import IllegalArgumentException
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.functions.vectors import l2_normalize
from winnow.operators.compare import diagnose_fit
from winnow.operators.metrics import evaluate_scores, mean_recall, ndcg_per_user, recall_per_user
from winnow.operators.nearest import exact_top_k
from winnow.runtime import materialize

# Starting point of the boosted trees.
GBT_DEFAULTS = {"maxDepth": 6, "stepSize": 0.1, "maxIter": 100, "featureSubsetStrategy": "0.8", "seed": 42}


class NdcgEvaluator(Evaluator):
    """Mean NDCG@k over users, for use with Spark's model selection."""

    k = Param(Params._dummy(), "k", "cut-off of the list", typeConverter=TypeConverters.toInt)
    ties = Param(Params._dummy(), "ties", "columns that order equal scores", typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, k: int = 10, ties: Sequence[str] = ("item_id",)):
        super().__init__()
        self._setDefault(k=10, ties=["item_id"])
        self._set(k=k, ties=list(ties))

    def _evaluate(self, dataset: DataFrame) -> float:
        k = self.getOrDefault(self.k)
        value = ndcg_per_user(dataset, (k,), ties=self.getOrDefault(self.ties)).agg(F.avg(f"ndcg_{k}")).first()[0]
        return float(value or 0.0)

    def isLargerBetter(self) -> bool:
        return True


def assemble(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)


def fit_boosted_trees(features: DataFrame, columns: Sequence[str], params: Mapping | None = None,
                      label: str = "rating"):
    """Fits all trees on train rows, then keeps those up to the least validation loss; ``features`` carries ``split``.

    Spark's own stop (``validationIndicatorCol``) has no patience: it ends at the first tree
    that lowers the loss by less than 1 %, often the second.
    """
    train, val = (assemble(features.where(F.col("split") == part), columns) for part in ("train", "val"))
    gbt = GBTRegressor(featuresCol="features", labelCol=label, **{**GBT_DEFAULTS, **(params or {})})
    model = gbt.fit(train)
    if val.isEmpty():
        return model
    loss = model.evaluateEachIteration(val, "squared")
    return first_trees(model, 1 + min(range(len(loss)), key=loss.__getitem__))


def first_trees(model: GBTRegressionModel, n: int) -> GBTRegressionModel:
    """The same model without the trees after the ``n``-th."""
    java = model._java_obj
    short = model._new_java_obj("org.apache.spark.ml.regression.GBTRegressionModel",
                                java.uid(), java.trees()[:n], java.treeWeights()[:n], java.numFeatures())
    kept = model._copyValues(GBTRegressionModel(short))
    kept._transfer_params_to_java()
    return kept


def predict(model, features: DataFrame, columns: Sequence[str]) -> DataFrame:
    return model.transform(assemble(features, columns)).drop("features")


def feature_importance(model, columns: Sequence[str], spark, n: int | None = 15) -> DataFrame:
    """Importance and share per feature, largest first; one row per feature."""
    rows = [(c, float(v)) for c, v in zip(columns, model.featureImportances.toArray())]
    total = sum(v for _, v in rows) or 1.0
    table = spark.createDataFrame(
        [(c, v, 100.0 * v / total) for c, v in rows], "feature string, importance double, pct double"
    ).orderBy(F.desc("importance"), F.asc("feature"))
    return table.limit(n) if n else table


def importance_by_group(importance: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    spark = importance.sparkSession
    members = spark.createDataFrame(
        [(g, c) for g, cols in groups.items() for c in cols], "feature_group string, feature string"
    )
    return importance.join(F.broadcast(members), "feature").groupBy("feature_group").agg(
        F.sum("importance").alias("importance"), F.sum("pct").alias("pct")
    )


def tune_boosted_trees(features: DataFrame, columns: Sequence[str], *, base: Mapping | None = None,
                       step_sizes: Sequence[float] = (0.05, 0.1, 0.2),
                       depth_changes: Sequence[int] = (1, 2),
                       ties: Sequence[str] = ("item_id",)) -> DataFrame:
    """Learning rates first, then depths only if the gap diagnosis asks for it.

    Every trial is a Spark ML fit scored by NDCG@10 on validation rows.  The
    loop runs over the small grid; the data stays distributed.
    """
    spark = features.sparkSession
    base = {**GBT_DEFAULTS, **(base or {})}
    trials: list[tuple] = []
    fitted: dict[int, tuple] = {}

    def trial(stage: str, params: Mapping) -> float:
        model = fit_boosted_trees(features, columns, params)
        scored = predict(model, features.where(F.col("split").isin("train", "val")), columns)
        val = evaluate_scores(scored.where(F.col("split") == "val"), ties=ties).first()
        fitted[len(trials)] = (params, scored)
        trials.append((len(trials), stage, float(params["stepSize"]), int(params["maxDepth"]),
                       model.getNumTrees, val["rmse"], val["mae"], val["ndcg_10"], val["ndcg_20"], "NONE"))
        return val["ndcg_10"]

    def best() -> int:
        return max(fitted, key=lambda i: (trials[i][7], -i))

    for step in step_sizes:
        trial("step_size", {**base, "stepSize": step})
    winner, scored = fitted[best()]
    action = diagnose_fit(scored, ties=ties).first()["action"]
    if action != "NONE":
        sign = -1 if action == "REDUCE_COMPLEXITY" else 1
        for change in depth_changes:
            depth = winner["maxDepth"] + sign * change
            if depth >= 1:
                trial("max_depth", {**winner, "maxDepth": depth})
    chosen = best()
    rows = [(*t[:9], action, t[0] == chosen) for t in trials]
    return spark.createDataFrame(
        rows, "trial int, stage string, step_size double, max_depth int, n_trees int, rmse double, "
        "mae double, ndcg_10 double, ndcg_20 double, action string, chosen boolean"
    )


def fit_embeddings(pairs: DataFrame, *, rank: int = 128, iterations: int = 10, reg: float = 0.01,
                   alpha: float = 10.0, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Unit vectors ``(id, vec)`` for users and items from index pairs of positives.

    Every round is checkpointed: the factors sent to the blocks of the round before,
    several times the size of the factors, are then deleted instead of kept for all rounds.
    """
    weights = pairs.groupBy("user_idx", "item_idx").agg(F.count(F.lit(1)).cast("float").alias("weight"))
    als = ALS(userCol="user_idx", itemCol="item_idx", ratingCol="weight", implicitPrefs=True, rank=rank,
              maxIter=iterations, regParam=reg, alpha=alpha, seed=seed,
              checkpointInterval=1)
    model = als.fit(weights)

    def unit(factors: DataFrame) -> DataFrame:
        vec = l2_normalize(F.col("features")).cast("array<float>")
        return factors.select(F.col("id").cast("long").alias("id"), vec.alias("vec"))

    return unit(model.userFactors), unit(model.itemFactors)


def retrieval_recall(users: DataFrame, items: DataFrame, wanted: DataFrame, ks: Sequence[int]) -> DataFrame:
    """Mean recall of exact retrieval with the given vectors; ``wanted`` has index pairs.

    Recall is a mean over the users of ``wanted``, so only they search, among all items.
    """
    asking = wanted.select(F.col("user_idx").alias("id")).distinct()
    users, items = materialize(users.join(asking, "id", "left_semi"), "users"), materialize(items, "items")
    found = exact_top_k(
        users.select(F.col("id").alias("query_id"), "vec"), items.select(F.col("id").alias("item_id"), "vec"),
        max(ks),
    ).select(F.col("query_id").alias("user_idx"), F.col("item_id").alias("item_idx"), "rank")
    return mean_recall(recall_per_user(found, wanted, ks, user="user_idx", item="item_idx"), ks)


def sweep_embeddings(pairs: DataFrame, wanted: DataFrame, grid: Mapping[str, Sequence], *,
                     seeds: Sequence[int] = (42,), ks: Sequence[int] = (10, 50, 100),
                     base: Mapping | None = None) -> DataFrame:
    """Fits every parameter combination with every seed and records its recall.

    A failing run is kept with its error, so one bad setting does not lose the
    others.
    """
    spark = pairs.sparkSession
    pairs, wanted = materialize(pairs), materialize(wanted)
    names = list(grid)
    rows = []
    for run, (values, seed) in enumerate(product(product(*grid.values()), seeds)):
        params = dict(zip(names, values))
        try:
            users, items = fit_embeddings(pairs, seed=seed, **{**(base or {}), **params})
            recall = retrieval_recall(users, items, wanted, ks).first()
            outcome = ("success", None, *[float(recall[f"recall_{k}"]) for k in ks])
        except (IllegalArgumentException, ValueError, TypeError) as error:  # a bad setting; anything else is raised
            outcome = ("failed", str(error).splitlines()[0], *[None for _ in ks])
        rows.append((run, seed, *[float(v) for v in values], *outcome))
    schema = ", ".join(
        ["run_id int", "seed int", *[f"{n} double" for n in names], "status string", "error string",
         *[f"recall_{k} double" for k in ks]]
    )
    return spark.createDataFrame(rows, schema)
