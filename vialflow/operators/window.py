"""Window jobs: per-group firsts and top-k, running aggregates, ranks, wells.

Running aggregates over a whole table (or over one very large group) would
normally put every row of that group in one task. ``running`` can instead
split the ordered rows into *blocks* (any column that never decreases along
the order, e.g. the day of a timestamp, or ``RANGE``, which range-partitions
the rows by their whole order, so the number of blocks follows the cluster):

1. a local running aggregate per (group, block) - many parallel tasks;
2. per (group, block) totals - a partial aggregate, tiny;
3. an exclusive prefix over the block totals (one row per block);
4. the prefix is joined back and combined with the local value.

The result is exact for any block assignment that respects the order; the
blocks only decide how the work is spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vialflow.functions.stats import rnd, rnd_half_up
from vialflow.session import written

_COMBINE = {"sum": "sum", "count": "sum", "max": "max", "min": "min"}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _agg(fn: str, col: Column) -> Column:
    return {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}[fn](col)


#: Block choice of ``running``: ranges of the whole order, cut by sampled
#: splitters, as many as the session has shuffle partitions.
RANGE = "range"


def range_blocks(df: DataFrame, keys: Sequence[Column], out: str = "_blk") -> DataFrame:
    """``df`` range-partitioned by ``keys`` with the range's number in ``out``.

    The numbers are fixed by writing the rows to the shared folder, so a retried
    task cannot see others, and what reads them prunes columns. Rows that tie on
    all keys share a range; the callers' orders end in a unique id where ties matter.
    """
    return written(df.repartitionByRange(*keys).withColumn(out, F.spark_partition_id()), "ranges")


def running(df: DataFrame, order: Sequence, aggs: dict, by: Sequence[str] = (),
            block: Column | str | None = None, exclusive: bool = False) -> DataFrame:
    """Add running aggregates ``{out: (fn, col)}`` (fn in sum/count/max/min)
    over rows ordered by ``order`` within ``by`` (frame: first row .. current,
    or .. the previous row when ``exclusive``; an empty frame gives NULL for
    max/min and 0 for sum/count).
    """
    by = list(by)
    order = [_c(o) for o in order]
    end = -1 if exclusive else 0
    if block is None:
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
        outs = []
        for out, (fn, col) in aggs.items():
            e = _agg(fn, _c(col)).over(w)
            outs.append((F.coalesce(e, F.lit(0)) if _COMBINE[fn] == "sum" else e).alias(out))
        return df.select("*", *outs)
    if isinstance(block, str) and block == RANGE:
        d = range_blocks(df, [*map(F.col, by), *order])
    else:
        d = df.withColumn("_blk", block)
    wl = Window.partitionBy(*by, "_blk").orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    local = d.select("*", *[_agg(fn, _c(col)).over(wl).alias(f"_l_{out}") for out, (fn, col) in aggs.items()])
    tot = d.groupBy(*by, "_blk").agg(*[_agg(fn, _c(col)).alias(f"_t_{out}") for out, (fn, col) in aggs.items()])
    wp = Window.partitionBy(*by).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    pre = tot.select(*by, "_blk", *[_agg(_COMBINE[fn], F.col(f"_t_{out}")).over(wp).alias(f"_p_{out}")
                                    for out, (fn, _col) in aggs.items()])
    j = local.join(pre, by + ["_blk"], "left")
    outs = []
    for out, (fn, _col) in aggs.items():
        lc, pc = F.col(f"_l_{out}"), F.col(f"_p_{out}")
        if _COMBINE[fn] == "sum":
            e = F.coalesce(pc, F.lit(0)) + F.coalesce(lc, F.lit(0))
        elif fn == "max":
            e = F.greatest(pc, lc)
        else:
            e = F.least(pc, lc)
        outs.append(e.alias(out))
    keep = [c for c in df.columns]
    return j.select(*keep, *outs)


def exact_quantiles(df: DataFrame, val: str | Column, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``by`` columns, ``_q`` (exact quantiles, linear interpolation) and ``_n``.

    Rows are counted per distinct value, the counts are summed along ranges of
    the values, and each quantile picks the two values around its place: no
    task holds the values of a group. NULL values do not count.
    """
    by = list(by)
    counts = (df.select(*by, _c(val).cast("double").alias("_v")).where(F.col("_v").isNotNull())
              .groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_k")))
    walk = running(counts, ["_v"], {"_cum": ("sum", "_k")}, by, block=RANGE)
    size = walk.groupBy(*by).agg(F.max("_cum").alias("_n"))
    # one row per group, or a single one
    walk = walk.join(size, by) if by else walk.crossJoin(F.broadcast(size))
    place = [F.lit(float(p)) * (F.col("_n") - 1) for p in probs]
    at = lambda rank: F.min(F.when(F.col("_cum") > rank, F.col("_v")))
    ends = walk.groupBy(*by).agg(F.max("_n").alias("_n"), *[
        e for i, p in enumerate(place) for e in (at(F.floor(p)).alias(f"_lo{i}"), at(F.ceil(p)).alias(f"_hi{i}"))])
    q = [F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (p - F.floor(p)) for i, p in enumerate(place)]
    return ends.select(*by, F.array(*q).alias("_q"), "_n")


def first_per_group(df: DataFrame, key, order: Sequence) -> DataFrame:
    """First row per group after a sort. The ``row_number() = 1`` filter lets
    Spark insert a partial WindowGroupLimit before the shuffle, so each map
    task forwards at most one row per group."""
    return topk_per_group(df, key, order, 1)


def topk_per_group(df: DataFrame, key, order: Sequence, k: int, rank_col: str = "rank") -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*[_c(o) for o in order])
    return (df.withColumn(rank_col, F.row_number().over(w).cast("bigint"))
            .where(F.col(rank_col) <= k))


def best_so_far(df: DataFrame, order: Sequence, cols: Sequence[str], by: Sequence[str] = (),
                block: Column | None = None) -> DataFrame:
    """Running maximum of each column (``best_<col>``)."""
    return running(df, order, {f"best_{c}": ("max", c) for c in cols}, by, block)


def running_mean(df: DataFrame, order: Sequence, val: str, by: Sequence[str] = (),
                 block: Column | None = None, out: str = "running_mean") -> DataFrame:
    """Cumulative average of ``val`` over the pulls made so far (T14)."""
    r = running(df, order, {"_rs": ("sum", val), "_rc": ("count", val)}, by, block)
    return r.withColumn(out, rnd_half_up(F.col("_rs") / F.col("_rc"))).drop("_rs", "_rc")


def row_index(df: DataFrame, order: Sequence, block: Column | str = RANGE,
              out: str = "idx") -> DataFrame:
    """0-based position of every row in a total order, distributed: a running
    count over order-respecting blocks, by default ranges of the order."""
    r = running(df.withColumn("_one", F.lit(1)), order, {"_n": ("count", "_one")}, (), block)
    return r.withColumn(out, (F.col("_n") - 1).cast("bigint")).drop("_n", "_one")


def cumulative_share(df: DataFrame, order: Sequence, val: str, block: Column | str = RANGE,
                     digits: int = 6) -> DataFrame:
    """Running sum of ``val`` divided by its total (a scalar subquery)."""
    total = df.agg(F.sum(val)).scalar()
    r = running(df, order, {"_cs": ("sum", val)}, (), block)
    return r.withColumn("cum_share", rnd(F.col("_cs") / total, digits)).drop("_cs")


def envelope(df: DataFrame, x: str, y: str, block: Column | str = RANGE,
             out: str = "envelope") -> DataFrame:
    """Upper envelope: running max of ``y`` walking ``x`` from high to low."""
    return running(df, [F.col(x).desc(), F.col(y).desc()], {out: ("max", y)}, (), block)


# Standard 96-well plate, 8 rows (A-H) x 12 columns, row-major.
PLATE_ROWS = 8
PLATE_COLS = 12


def assign_wells(df: DataFrame, order: Sequence, plate_size: int = 96,
                 block: Column | str = RANGE) -> DataFrame:
    """Index -> plate, row letter, column, well name (row-major, 1-based plate)."""
    cols = PLATE_COLS if plate_size == 96 else int(round((plate_size * 1.5) ** 0.5))
    r = row_index(df, order, block)
    within = F.col("idx") % F.lit(plate_size)
    row_letter = F.chr(F.lit(65) + F.floor(within / F.lit(cols)).cast("int"))
    col_no = (within % F.lit(cols) + 1).cast("int")
    return r.select("*",
                    (F.floor(F.col("idx") / F.lit(plate_size)) + 1).cast("bigint").alias("plate"),
                    row_letter.alias("plate_row"), col_no.alias("plate_col"),
                    F.concat(row_letter, col_no.cast("string")).alias("well"))


def plate_occupancy(wells: DataFrame) -> DataFrame:
    """Rows A-H per plate, columns 1..12 holding the count of assigned items
    (0 for empty wells)."""
    spark = wells.sparkSession
    plates = wells.select("plate").distinct()
    letters = spark.range(PLATE_ROWS).select(F.chr(F.lit(65) + F.col("id").cast("int")).alias("plate_row"))
    grid = plates.crossJoin(F.broadcast(letters))  # plates x 8 rows: bounded by plate count
    counts = (wells.groupBy("plate", "plate_row")
              .pivot("plate_col", list(range(1, PLATE_COLS + 1))).agg(F.count(F.lit(1))))
    j = grid.join(counts, ["plate", "plate_row"], "left")
    return j.select("plate", "plate_row", *[F.coalesce(F.col(str(c)), F.lit(0)).cast("bigint").alias(str(c))
                                      for c in range(1, PLATE_COLS + 1)])


def cumulative_regret(df: DataFrame, arm: str, reward: str, order: Sequence,
                      block: Column | None = None, digits: int = 6) -> DataFrame:
    """Regret after each pull: ``best_arm_mean * t - cumulative reward``."""
    best = df.groupBy(arm).agg(F.avg(reward).alias("_m")).agg(F.max("_m")).scalar()
    r = running(df.withColumn("_one", F.lit(1)), order,
                {"_cum": ("sum", reward), "t": ("count", "_one")}, (), block)
    return r.select(*[c for c in df.columns], F.col("t").cast("bigint").alias("t"),
                    rnd(F.col("_cum"), digits).alias("cum_reward"),
                    rnd(best * F.col("t") - F.col("_cum"), digits).alias("regret"))


def hit_rate_at_k(df: DataFrame, score: str, y: str, id_col: str, ks: Sequence[int],
                  digits: int = 6) -> DataFrame:
    """Rank by score (desc, id asc) and report hits and hit rate in the top k.

    Only the top ``max(ks)`` rows are ever ranked: Spark's TakeOrdered keeps
    a bounded heap per partition, so no global sort of the table happens.
    """
    kmax = max(ks)
    top = df.orderBy(F.col(score).desc_nulls_last(), F.col(id_col).asc()).limit(kmax)
    w = Window.orderBy(F.col(score).desc_nulls_last(), F.col(id_col).asc())
    ranked = top.withColumn("_rank", F.row_number().over(w))  # <= kmax rows
    spark = df.sparkSession
    kdf = spark.createDataFrame([(int(k),) for k in ks], "k bigint")
    j = F.broadcast(kdf).join(ranked, F.col("_rank") <= F.col("k"))
    return j.groupBy("k").agg(F.sum(F.col(y)).cast("bigint").alias("hits"),
                              F.count(F.lit(1)).cast("bigint").alias("n"),
                              rnd(F.avg(F.col(y).cast("double")), digits).alias("hit_rate"))


def representatives(df: DataFrame, label: str, id_col: str, n: int = 2) -> DataFrame:
    """First ``n`` members (by id) of each cluster."""
    return topk_per_group(df, label, [F.col(id_col).asc()], n, rank_col="member")
