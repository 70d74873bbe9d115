"""Positives, contiguous ids, training pairs, negatives and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from winnow.functions.hashing import coprime_strides, pick, seeded_int, seeded_key, times_modulo
from winnow.operators.ranks import global_rank
from winnow.runtime import materialize

_LISTED = 1_000  # positives of a user that are held in one array


def positives(df: DataFrame, threshold: float = 4, rating: str = "rating") -> DataFrame:
    """Implicit feedback: rows rated at least ``threshold``."""
    return df.where(F.col(rating) >= threshold)


def id_map(df: DataFrame, key: str, name: str | None = None) -> DataFrame:
    """``(id, idx)``: contiguous 0-based index over the sorted distinct ids."""
    return global_rank(df.select(key).distinct(), [key], name or f"{key}x")


def verify_id_map(mapping: DataFrame, key: str, idx: str) -> DataFrame:
    """One row of checks: both directions unique, indexes are 0..n-1."""
    # Duplicates are counted per value first, so no set is built in one task.
    def distinct_rows(c: str, out: str) -> DataFrame:
        return mapping.select(c).distinct().agg(F.count(F.lit(1)).alias(out))

    base = mapping.agg(
        F.count(F.lit(1)).alias("n"), F.min(idx).alias("min_idx"), F.max(idx).alias("max_idx")
    )
    one = F.lit(1).alias("__j")
    return (
        base.select("*", one)
        .join(distinct_rows(key, "n_ids").select("*", one), "__j")
        .join(distinct_rows(idx, "n_idx").select("*", one), "__j")
        .select(
            "n", "n_ids", "n_idx", "min_idx", "max_idx",
            ((F.col("n") == F.col("n_ids")) & (F.col("n") == F.col("n_idx"))).alias("bijective"),
            ((F.col("min_idx") == 0) & (F.col("max_idx") == F.col("n") - 1)).alias("contiguous"),
        )
    )


def training_pairs(pos: DataFrame, users: DataFrame, items: DataFrame, *, user: str = "user_id",
                   item: str = "item_id") -> DataFrame:
    """Rows as index pairs; rows with an unmapped user or item are dropped.

    The maps are joined by key: Spark broadcasts them only when their measured
    size allows it and splits skewed partitions otherwise.
    """
    return pos.join(users, user).join(items, item)


def positive_sets(pairs: DataFrame, *, user_idx: str, item_idx: str,
                  chunk: int = 10_000) -> DataFrame:
    """Sorted distinct items per user, in arrays covering ``chunk`` indexes each.

    A user's set is spread over rows ``part = item_idx div chunk``, so that no
    array can exceed ``chunk`` elements however active the user is.
    """
    return (
        pairs.select(user_idx, item_idx)
        .distinct()
        .groupBy(user_idx, F.floor(F.col(item_idx) / chunk).cast("long").alias("part"))
        .agg(F.array_sort(F.collect_list(item_idx)).alias("items"))
    )


def positive_sets_json(sets: DataFrame, *, user_idx: str) -> DataFrame:
    """The same sets as JSON objects ``{"<user>": [items]}``."""
    entry = F.map_from_arrays(F.array(F.col(user_idx).cast("string")), F.array(F.col("items")))
    return sets.select(user_idx, "part", F.to_json(entry).alias("json"))


def negative_samples(pairs: DataFrame, n_items: int, per_positive: int = 4, seed: int = 7, *,
                     user_idx: str = "user_idx", item_idx: str = "item_idx") -> DataFrame:
    """``per_positive`` distinct unseen items for each distinct positive pair.

    Every pair walks the item indexes in its own pseudo-random order (start
    from a hash, stride coprime to ``n_items``) and keeps the first items that
    its user has not seen, or all of them if there are fewer.  Pairs still
    short after a round walk further.

    A user with ``u`` unseen items lets a pair walk about ``n_items / u`` steps
    per item.  Where that would be more than ``u``, the unseen items are listed
    once for the user and each pair takes those that come first in its walk, so
    a pair never costs more than about twice the root of ``n_items`` rows.

    Users with at most ``_LISTED`` positives have them in one array, and a pair
    walks past it where it is, so no candidate of theirs is shuffled.  The walks
    of the others meet the seen pairs in a join that deals a user's rows over
    all tasks.
    """
    seen = materialize(pairs.select(user_idx, item_idx).distinct(), "pairs")
    stride, inverse = coprime_strides(n_items, 1)[0]
    start = F.pmod(seeded_int(seed, user_idx, item_idx), F.lit(n_items))
    count = F.count(F.lit(1))
    few_left = ((n_items - count) * (n_items - count) < 4 * n_items) | (n_items - count < per_positive)
    # Users that get no array: few unseen items, or many positives.
    apart = materialize(
        seen.groupBy(user_idx).agg(few_left.alias("__dense"), count.alias("__n"))
        .where(F.col("__dense") | (F.col("__n") > _LISTED)).select(user_idx, "__dense"), "apart")
    dense = apart.where("__dense").select(user_idx)
    known = seen.select(F.col(user_idx), F.col(item_idx).alias("neg_idx"))
    marked = seen.join(apart, user_idx, "left")
    short_list = F.col("__dense").isNull() & F.col(user_idx).isNotNull() & F.col(item_idx).isNotNull()
    out = _walk_past_lists(marked.where(short_list).select(user_idx, item_idx), start, stride, n_items, per_positive,
                           user_idx, item_idx)
    w = Window.partitionBy(user_idx, item_idx).orderBy("__r")
    if not dense.isEmpty():
        listed = _unseen_of(dense, known.join(dense, user_idx, "left_semi"), n_items, user_idx)
        order = times_modulo(F.pmod(F.col("neg_idx") - F.col("__start"), F.lit(n_items)), inverse, n_items)
        near = (
            seen.withColumn("__start", start).join(listed, user_idx).withColumn("__r", order)
            .withColumn("n", F.row_number().over(w)).where(F.col("n") <= per_positive)
        )
        out = out.unionByName(near.select(user_idx, item_idx, F.col("n").cast("int").alias("n"), "neg_idx"))
    todo = materialize(
        marked.where(~short_list & ~F.coalesce("__dense", F.lit(False)))
        .select(user_idx, item_idx, start.alias("__start"), F.lit(0).cast("long").alias("__have")), "short")
    walked = known.join(todo.select(user_idx).distinct(), user_idx, "left_semi")
    lo, width = 0, 2 * per_positive
    while lo < n_items and not todo.isEmpty():
        hi = min(lo + width, n_items)
        step = F.pmod(F.col("__start") + times_modulo(F.col("__r"), stride, n_items), F.lit(n_items))
        drawn = (
            todo.withColumn("__r", F.explode(F.sequence(F.lit(lo).cast("long"), F.lit(hi - 1).cast("long"))))
            .withColumn("neg_idx", step)
            .join(walked, [user_idx, "neg_idx"], "left_anti")
            # A walk has at most `width` rows per pair.
            .withColumn("n", F.row_number().over(w) + F.col("__have"))
            .where(F.col("n") <= per_positive)
        )
        got = materialize(drawn.select(user_idx, item_idx, F.col("n").cast("int").alias("n"), "neg_idx"), "negatives")
        out = out.unionByName(got)
        counts = got.groupBy(user_idx, item_idx).agg(F.count(F.lit(1)).alias("__got"))
        todo = materialize(
            todo.join(counts, [user_idx, item_idx], "left")
            .withColumn("__have", F.col("__have") + F.coalesce("__got", F.lit(0)))
            .drop("__got")
            .where(F.col("__have") < per_positive), "short")
        lo, width = hi, width * 2
    return out


def _walk_past_lists(seen: DataFrame, start: Column, stride: int, n_items: int, per_positive: int,
                     user_idx: str, item_idx: str) -> DataFrame:
    """The walks of users whose positives fit in an array; ``seen`` has their distinct pairs.

    ``array_except`` keeps the order of the walk.  Of as many steps as a user
    has positives, and ``per_positive`` more, enough are unseen, so the second
    walk is the last; few pairs need it.
    """
    pairs = (
        seen.groupBy(user_idx).agg(F.collect_list(item_idx).alias("__items"))
        .select(user_idx, "__items", F.explode("__items").alias(item_idx)).withColumn("__start", start)
    )
    size = F.lit(n_items).cast("long")
    # One expression per step, so this walk stays short however many are asked for.
    first = F.array(*[F.pmod(F.col("__start") + r * stride % n_items, size)
                      for r in range(min(2 * per_positive, n_items, 32))])
    last = F.least(F.size("__items") + per_positive, size) - 1
    steps = F.transform(F.sequence(F.lit(0).cast("long"), last),
                        lambda r: F.pmod(F.col("__start") + times_modulo(r, stride, n_items), size))
    free = pairs.withColumn("__free", F.array_except(first, "__items"))
    enough = F.when(F.size("__free") >= per_positive, F.col("__free")).otherwise(F.array_except(steps, F.col("__items")))
    return (
        free.select(user_idx, item_idx, F.posexplode(F.slice(enough, 1, per_positive)).alias("__at", "neg_idx"))
        .select(user_idx, item_idx, (F.col("__at") + 1).alias("n"), "neg_idx")
    )


def _unseen_of(users: DataFrame, known: DataFrame, n_items: int, user_idx: str) -> DataFrame:
    """``(user, neg_idx)`` of the unseen items; the catalogue is listed in bounded ranges."""
    span = 100_000
    ranges = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(0, n_items - 1)).cast("long"), F.lit(span).cast("long")))
    last = F.least(F.col("__lo") + span - 1, F.lit(n_items - 1).cast("long"))
    every = users.select(user_idx, ranges.alias("__lo")).select(user_idx, F.explode(F.sequence(F.col("__lo"), last)).alias("neg_idx"))
    return materialize(every.join(known, [user_idx, "neg_idx"], "left_anti"), "unseen")


def training_batches(pairs: DataFrame, batch_size: int, seed: int, *keys: str) -> DataFrame:
    """Shuffles the rows by a seeded hash of ``keys`` and cuts them into batches."""
    keyed = pairs.withColumn("__h", seeded_key(seed, *keys))
    ranked = global_rank(keyed, ["__h", *keys], "pos")
    return ranked.withColumn("batch_id", F.floor(F.col("pos") / batch_size).cast("long")).drop("__h")


def random_rank(df: DataFrame, n_items: int, seed: int, *, user: str, item_idx: str) -> DataFrame:
    """Adds the 1-based rank an item has in the user's own random item order.

    Each user gets a permutation ``start + rank * stride (mod n_items)``, so the
    rank of a given item follows by arithmetic and no list is ever built.
    """
    choices = coprime_strides(n_items)
    h = seeded_int(seed, user)
    inverse = pick([inv for _, inv in choices], F.pmod(h, F.lit(len(choices))))
    start = F.pmod(h, F.lit(n_items))
    steps = times_modulo(F.pmod(F.col(item_idx) - start, F.lit(n_items)), inverse, n_items)
    return df.withColumn("rank", steps + 1)
