"""Exact order statistics found by narrowing histograms.

Each pass is one scan with a map-side aggregate: only a bounded number of
histogram rows is shuffled, whatever the size or skew of the data.  Nothing is
sorted globally and no group is gathered in one task.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence
from functools import reduce
from math import ceil, floor
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from winnow.runtime import materialize

BUCKETS = 4096
FETCH_ROWS = 20_000
FETCH_BRACKET = 4_096
BRACKET_BITS = 8
_MAGNITUDE = (1 << 63) - 1


def _as_long(df: DataFrame, name: str) -> Column:
    """Order-preserving integer form of a key column."""
    kind = df.schema[name].dataType
    c = F.col(name)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("long")
    if isinstance(kind, T.DateType):
        return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        # An interval, so no time zone is involved.
        return F.expr(f"(`{name}` - TIMESTAMP_NTZ '1970-01-01 00:00:00') div INTERVAL '0.000001' SECOND")
    raise TypeError(f"{name}: order keys must be integers, dates or timestamps, not {kind}")


def _histogram(scope: DataFrame, key: str, lo: int, hi: int, buckets: int) -> list:
    """Rows and key range per equally wide bucket; at most ``buckets`` rows."""
    width = (hi - lo) // buckets + 1
    return (
        scope.groupBy(F.expr(f"({key} - {lo}L) div {width}L").alias("b"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"))
        .orderBy("b")
        .collect()
    )


def _bucket_of(hist: list, rank: int):
    """The bucket holding the 1-based ``rank`` and the rank inside it."""
    for bucket in hist:
        if rank <= bucket["n"]:
            break
        rank -= bucket["n"]
    return bucket, rank


def rows_at(df: DataFrame, keys: Sequence[str], ratios: Sequence[float], *,
            fetch_rows: int = FETCH_ROWS, buckets: int = BUCKETS) -> list[dict[str, Column] | None]:
    """Key values of the rows at positions ``int(n * ratio)`` of the order of ``keys``.

    The keys are unique together and never null.  Values come back as literals
    of the original types, so that comparing with them reaches the scan.  Only
    the leading keys needed to separate the row from its successor are given,
    which spares later scans the other columns.  A position of 0 gives None.
    """
    longs = [f"__k{i}" for i in range(len(keys))]
    scope = df.select(
        *[F.col(k).cast("string").alias(k) for k in keys],
        *[_as_long(df, k).alias(n) for k, n in zip(keys, longs)],
    )
    missing = F.count_if(reduce(or_, [F.col(k).isNull() for k in longs]))
    lo, hi, n, nulls = scope.agg(
        F.min(longs[0]), F.max(longs[0]), F.count(F.lit(1)), missing
    ).first()
    if nulls:
        raise ValueError(f"{nulls} rows have no value in one of the order keys {list(keys)}")
    first = _histogram(scope, longs[0], lo, hi, buckets) if n > fetch_rows and lo != hi else None
    picks = []
    for at, ratio in enumerate(ratios):
        rank = int(n * ratio)
        if rank < 1:
            continue
        bounds, inside = (lo, hi, n), scope
        if first:
            bucket, rank = _bucket_of(first, rank)
            bounds = (bucket["lo"], bucket["hi"], bucket["n"])
            inside = scope.where(F.col(longs[0]).between(*bounds[:2]))
        picks.append(_row_at(inside, longs, rank, bounds, fetch_rows, buckets).withColumn("__at", F.lit(at)))
    rows = reduce(DataFrame.unionAll, picks).collect() if picks else []  # two rows per ratio
    out: list[dict[str, Column] | None] = []
    for at in range(len(ratios)):
        pair = sorted((r for r in rows if r["__at"] == at), key=lambda r: [r[n] for n in longs])
        if not pair:
            out.append(None)
            continue
        if len(pair) == 2 and all(pair[0][n] == pair[1][n] for n in longs):
            raise ValueError(f"the order keys {list(keys)} do not tell the rows at a boundary apart")
        # Keys after the first one that differs from the next row decide nothing.
        differs = [i for i, n in enumerate(longs) if len(pair) == 2 and pair[0][n] != pair[1][n]]
        needed = keys[: differs[0] + 1] if differs else keys
        out.append({k: F.lit(pair[0][k]).cast(df.schema[k].dataType) for k in needed})
    return out


def _row_at(scope: DataFrame, longs: Sequence[str], rank: int, bounds: tuple, fetch_rows: int,
            buckets: int) -> DataFrame:
    """Narrows one key after the other until few rows are left; asks for one row and its successor."""
    lo, hi, n = bounds
    for depth, key in enumerate(longs):
        if depth:
            lo, hi, n = scope.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
        while lo != hi and n > fetch_rows:
            bucket, rank = _bucket_of(_histogram(scope, key, lo, hi, buckets), rank)
            lo, hi, n = bucket["lo"], bucket["hi"], bucket["n"]
            scope = scope.where(F.col(key).between(lo, hi))
        if n <= fetch_rows:
            break
        scope = scope.where(F.col(key) == lo)
    else:
        rank = 1  # more than `fetch_rows` rows agree in every key
    return scope.orderBy(*longs).offset(rank - 1).limit(2)


def at_or_before(bound: dict[str, Column]) -> Column:
    """Lexicographic ``keys <= bound``.

    The leading comparison follows from the rest and is repeated in a form the
    file scan understands.
    """
    names = list(bound)
    out = F.col(names[-1]) <= bound[names[-1]]
    for name in reversed(names[:-1]):
        out = (F.col(name) < bound[name]) | ((F.col(name) == bound[name]) & out)
    return (F.col(names[0]) <= bound[names[0]]) & out


def after(bound: dict[str, Column]) -> Column:
    """Lexicographic ``keys > bound``."""
    names = list(bound)
    out = F.col(names[-1]) > bound[names[-1]]
    for name in reversed(names[:-1]):
        out = (F.col(name) > bound[name]) | ((F.col(name) == bound[name]) & out)
    return (F.col(names[0]) >= bound[names[0]]) & out


def ordered_bits(value: Column) -> Column:
    """A double as a 64-bit integer of the same order, infinities and denormals included."""
    # Adding zero makes both zeros one.
    bits = F.call_function("reflect", F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value + F.lit(0.0)).cast("long")
    return bits.bitwiseXOR(F.shiftright(bits, 63).bitwiseAND(F.lit(_MAGNITUDE)))


def from_ordered_bits(key: int) -> float:
    return struct.unpack("<d", struct.pack("<q", key ^ ((key >> 63) & _MAGNITUDE)))[0]


def quantiles(df: DataFrame, group: str, value: str, probs: Sequence[float], *,
              fetch: int = FETCH_BRACKET, bits: int = BRACKET_BITS) -> DataFrame:
    """Exact linear-interpolated quantiles of a double column per group.

    ``df`` is long form with few groups (feature names).  Every requested position is
    narrowed by histograms over the order-preserving integer form of the values, whose
    range shrinks by a fixed factor in each pass, until its bracket is one value or holds
    at most ``fetch`` rows, which are then sorted together.  The same steps are taken
    at every size.  Null and NaN are left out.
    Returns ``(group, quantiles)`` with one array in the order of ``probs``.
    """
    spark, kind = df.sparkSession, df.schema[group].dataType.simpleString()
    usable = df.where(F.col(value).isNotNull() & ~F.isnan(value))
    rows = usable.select(F.col(group).alias("g"), ordered_bits(F.col(value).cast("double")).alias("key"))
    sizes = (
        rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))
        .collect()  # one row per feature
    )
    open_ = {
        (s["g"], at): (s["lo"], s["hi"], s["n"], at)
        for s in sizes for p in probs for at in (floor((s["n"] - 1) * p), ceil((s["n"] - 1) * p))
    }
    found: dict = {}

    def scoped(brackets: set) -> DataFrame:
        cut = [(g, lo, hi, max(0, (hi - lo).bit_length() - bits)) for g, lo, hi in brackets]
        small = spark.createDataFrame(cut, f"b_g {kind}, lo long, hi long, s int")
        inside = F.col("g").eqNullSafe(F.col("b_g")) & F.col("key").between(F.col("lo"), F.col("hi"))
        return rows.join(F.broadcast(small), inside)  # a few brackets per feature

    for _ in range(64 // (bits - 1) + 2):
        for at, (lo, hi, _, _) in list(open_.items()):
            if lo == hi:
                found[at] = from_ordered_bits(lo)
                del open_[at]
        wide = {(at[0], b[0], b[1]) for at, b in open_.items() if b[2] > fetch}
        if not wide:
            break
        # Halves are subtracted, since the whole difference may need 64 bits.
        bucket = F.expr("if(s = 0, key - lo, shiftright(shiftright(key, 1) - shiftright(lo, 1), s - 1))")
        hist: dict = {}
        counted = (
            scoped(wide).groupBy("g", "lo", "hi", bucket.alias("b"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("k_lo"), F.max("key").alias("k_hi"))
            .orderBy("g", "lo", "hi", "b")
            .collect()  # brackets x 2**bits rows
        )
        for r in counted:
            hist.setdefault((r["g"], r["lo"], r["hi"]), []).append(r)
        for at, (lo, hi, _, offset) in list(open_.items()):
            for r in hist.get((at[0], lo, hi), []):
                if offset < r["n"]:
                    open_[at] = (r["k_lo"], r["k_hi"], r["n"], offset)
                    break
                offset -= r["n"]
    else:
        raise RuntimeError("a bracket did not shrink")
    if open_:
        brackets = {(at[0], b[0], b[1]) for at, b in open_.items()}
        sorted_ = (
            scoped(brackets).groupBy("g", "lo", "hi")
            .agg(F.sort_array(F.collect_list("key")).alias("keys"))  # at most `fetch` rows each
            .collect()
        )
        lists = {(r["g"], r["lo"], r["hi"]): r["keys"] for r in sorted_}
        for at, (lo, hi, _, offset) in open_.items():
            found[at] = from_ordered_bits(lists[(at[0], lo, hi)][offset])
    out = []
    for s in sizes:
        qs = []
        for p in probs:
            h = (s["n"] - 1) * p
            low, high = found[(s["g"], floor(h))], found[(s["g"], ceil(h))]
            qs.append(low if low == high else (ceil(h) - h) * low + (h - floor(h)) * high)
        out.append((s["g"], qs))
    return spark.createDataFrame(out, f"{group} {kind}, quantiles array<double>")


def counted_percentiles(df: DataFrame, value: str, probs: Sequence[float],
                        keys: Sequence[str] = ()) -> DataFrame:
    """Quantiles of a column with a bounded set of values (counts, shares rounded
    to six digits): equal values are merged before they meet in one group."""
    return (
        df.groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("__n"))
        .groupBy(*keys)
        .agg(F.percentile(value, F.lit(list(probs)), F.col("__n")).alias("quantiles"))
    )


SKETCH_ACCURACY = 10_000  # Spark's sketch: rank error at most n / accuracy
KEPT_ROWS = 2_000_000  # values of a slot that one window sorts


def bracket_aggregates(value: str, probs: Sequence[float], accuracy: int = SKETCH_ACCURACY) -> list[Column]:
    """Aggregates of the first scan: usable values and sketch brackets ``probs +- 3 / accuracy``.

    Add them to a ``groupBy`` that computes other statistics, so both share one scan.
    """
    delta = 3.0 / accuracy
    edges = [max(0.0, p - delta) for p in probs] + [min(1.0, p + delta) for p in probs]
    v = F.when(~F.isnan(value), F.col(value).cast("double") + F.lit(0.0))
    return [F.count(v).alias("__n"), F.percentile_approx(v, F.array(*map(F.lit, edges)), accuracy).alias("__bounds")]


def _slot(v: Column, ends: Sequence[str]) -> Column:
    """Number of the slot of ``v`` among ascending end columns: ``2j + 1`` at end ``j``, ``2j`` below it."""

    def between(a: int, b: int) -> Column:
        if a == b:
            return F.lit(2 * a)
        mid = (a + b) // 2
        return F.when(v < F.col(ends[mid]), between(a, mid)).when(v == F.col(ends[mid]), F.lit(2 * mid + 1)).otherwise(between(mid + 1, b))

    return between(0, len(ends))


def bracketed_quantiles(df: DataFrame, group: str, value: str, probs: Sequence[float], sketched: DataFrame, *,
                        accuracy: int = SKETCH_ACCURACY, fetch: int = KEPT_ROWS) -> DataFrame:
    """Exact linear-interpolated quantiles per group in one more scan, from the first scan's brackets.

    ``sketched`` holds ``group`` and the columns of ``bracket_aggregates`` (one row per group).
    The distinct ends of a group's brackets cut its values into slots: a slot is one end, or what
    lies strictly between two.  The second scan counts the rows of every slot, and keeps apart the
    values of slots inside a bracket where the sketch's rank bound keeps them below ``fetch`` (at
    most ``8 n / accuracy + 2``).  Each wanted position is looked up in the counts; a group with a
    position in a slot that was not kept apart is found by the narrowing of ``quantiles`` instead.
    Null and NaN are left out; -0.0 is 0.0.
    Returns ``(group, quantiles)`` like ``quantiles``.
    """
    spark, kind = df.sparkSession, df.schema[group].dataType.simpleString()
    k = len(probs)
    rows = {r[group]: r for r in sketched.select(group, "__n", "__bounds").collect()}  # one row per group
    ends = {g: sorted(set(r["__bounds"])) for g, r in rows.items() if r["__n"]}
    if not ends:
        return spark.createDataFrame([], f"{group} {kind}, quantiles array<double>")
    names = [f"e{j}" for j in range(max(map(len, ends.values())))]
    cuts = []
    for g, e in ends.items():
        r = rows[g]
        few = 8 * r["__n"] / accuracy + 2 <= fetch
        brackets = list(zip(r["__bounds"][:k], r["__bounds"][k:]))
        # Slot 2j + 1 is end j, slot 2j what lies between the ends j - 1 and j.
        kept = [s % 2 == 0 and few and 0 < s < 2 * len(e) and any(lo <= e[s // 2 - 1] and e[s // 2] <= hi for lo, hi in brackets)
                for s in range(2 * len(names) + 1)]
        # NaN is greater than every value, so a group with fewer ends has no rows beyond them.
        cuts.append((g, *e, *[float("nan")] * (len(names) - len(e)), kept))
    table = spark.createDataFrame(cuts, f"b_g {kind}, {', '.join(f'{c} double' for c in names)}, kept array<boolean>")
    usable = df.where(F.col(value).isNotNull() & ~F.isnan(value)).select(
        F.col(group).alias("g"), (F.col(value).cast("double") + F.lit(0.0)).alias("v"))
    joined = usable.join(F.broadcast(table), F.col("g").eqNullSafe(F.col("b_g")))  # one row of ends per group
    slots = joined.select("g", "v", "kept", _slot(F.col("v"), names).alias("slot"))
    apart = F.when(F.get("kept", F.col("slot")), F.col("v"))
    counted = materialize(slots.groupBy("g", "slot", apart.alias("v")).agg(F.count(F.lit(1)).alias("n")), "slots")
    sizes: dict = {g: {} for g in ends}
    for r in counted.groupBy("g", "slot").agg(F.sum("n").alias("n")).collect():  # a few slots per group
        sizes[r["g"]][r["slot"]] = r["n"]
    # A slot holds at most ``fetch`` of the values kept apart, so a window sorts little at once.
    order = Window.partitionBy("g", "slot").orderBy("v")
    wanted, places, missed = [], {}, []
    for g, e in ends.items():
        kept = next(c[-1] for c in cuts if c[0] == g)
        mine = {}
        for p in probs:
            h = (rows[g]["__n"] - 1) * p
            for at in (floor(h), ceil(h)):
                offset = at
                for slot in sorted(sizes[g]):
                    if offset < sizes[g][slot]:
                        break
                    offset -= sizes[g][slot]
                mine[at] = (slot, offset)
        if any(slot % 2 == 0 and not kept[slot] for slot, _ in mine.values()):
            missed.append(g)
            continue
        places[g] = mine
        wanted += [(g, slot, offset) for slot, offset in set(mine.values()) if slot % 2 == 0]
    values = {}
    if wanted:
        asked = spark.createDataFrame(wanted, f"a_g {kind}, a_slot int, offset long")
        ranked = counted.where("v is not null").withColumn("upto", F.sum("n").over(order))
        inside = (F.col("g").eqNullSafe(F.col("a_g")) & (F.col("slot") == F.col("a_slot"))
                  & (F.col("offset") < F.col("upto")) & (F.col("offset") >= F.col("upto") - F.col("n")))
        found_ = ranked.join(F.broadcast(asked), inside).select("g", "slot", "offset", "v")  # a few positions per group
        values = {(r["g"], r["slot"], r["offset"]): r["v"] for r in found_.collect()}
    out = []
    for g, mine in places.items():
        n, qs = rows[g]["__n"], []
        for p in probs:
            h = (n - 1) * p
            low, high = (ends[g][slot // 2] if slot % 2 else values[(g, slot, offset)]
                         for slot, offset in (mine[floor(h)], mine[ceil(h)]))
            qs.append(low if low == high else (ceil(h) - h) * low + (h - floor(h)) * high)
        out.append((g, qs))
    found = spark.createDataFrame(out, f"{group} {kind}, quantiles array<double>")
    if missed:
        rest = df.where(F.col(group).isin(missed) if None not in missed else F.col(group).isin(missed) | F.col(group).isNull())
        found = found.unionByName(quantiles(rest, group, value, probs))
    return found
