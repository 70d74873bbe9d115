"""Training losses evaluated on tables of vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.functions.vectors import dot


def bpr_loss(df: DataFrame, pos_score: str, neg_score: str) -> DataFrame:
    """Mean of ``-log sigmoid(pos - neg)``, stable for either sign."""
    gap = F.col(pos_score) - F.col(neg_score)
    loss = F.log1p(F.exp(-F.abs(gap))) + F.greatest(-gap, F.lit(0.0))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.avg(loss).alias("bpr_loss"))


def inbatch_softmax_loss(batches: DataFrame, temperature: float = 0.1, *, batch: str = "batch_id",
                         user_vec: str = "user_vec", item_vec: str = "item_vec") -> DataFrame:
    """Cross-entropy of each row's own item against all items of its batch.

    A batch is bounded by the batch size, so its logits are one small matrix
    product inside a task and no pairs are written out.
    """

    def loss(pdf: pd.DataFrame) -> pd.DataFrame:
        u = np.stack(pdf[user_vec].to_numpy()).astype(np.float64)
        v = np.stack(pdf[item_vec].to_numpy()).astype(np.float64)
        logits = u @ v.T / temperature
        top = logits.max(axis=1)
        log_norm = top + np.log(np.exp(logits - top[:, None]).sum(axis=1))
        return pd.DataFrame(
            {batch: [pdf[batch].iloc[0]], "n_rows": [len(pdf)],
             "loss": [float((log_norm - logits.diagonal()).mean())]}
        )

    return batches.select(batch, user_vec, item_vec).groupBy(batch).applyInPandas(
        loss, f"{batch} long, n_rows long, loss double"
    )


def pair_scores(pairs: DataFrame, user_vectors: DataFrame, item_vectors: DataFrame, *,
                user: str = "user_id", item: str = "item_id", name: str = "score") -> DataFrame:
    """Dot product for given pairs; pairs without both vectors drop out."""
    return (
        pairs.join(user_vectors, user).join(item_vectors, item)
        .withColumn(name, dot(F.col("user_vec"), F.col("item_vec")))
        .drop("user_vec", "item_vec")
    )
