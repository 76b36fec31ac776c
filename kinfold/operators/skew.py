"""Results per key where a few keys hold most rows, and joins with such keys."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def found_keys(df: DataFrame, key: str, share: float = 0.05) -> DataFrame:
    """Keys (not null) that hold more than `share` of all rows, null-key rows included in the total.

    Counts combine map-side, so a key with a third of all rows sends one partial row per task. At most 1/share keys come out.
    Empty table: no rows. Repeated rows count each time; other columns are never read."""
    per_key = df.groupBy(F.col(key).alias(key)).agg(F.count(F.lit(1)).alias("_n"))
    total = per_key.agg(F.sum("_n").alias("_total"))
    return per_key.join(F.broadcast(total)).where(F.col(key).isNotNull() & (F.col("_n") > F.lit(share) * F.col("_total"))).select(key)


def key_stats(df: DataFrame, key: str) -> DataFrame:
    """One row per key (the null key too): rows, present names and addresses, first and last update, distinct names.

    All but the distinct count are algebraic and combine map-side. The distinct count goes through (key, name) pairs first, so that a hot
    key's names spread over all tasks and only one partial count per task and key moves on."""
    pairs = df.groupBy(F.col(key).alias(key), F.col("business_name")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("business_address").alias("n_address"),
        F.min("updated_at").alias("first_update"),
        F.max("updated_at").alias("last_update"),
    )
    return pairs.groupBy(key).agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("business_name").isNotNull(), F.col("n")).otherwise(0)).alias("n_names"),
        F.sum("n_address").alias("n_addresses"),
        F.count("business_name").alias("n_distinct_names"),
        F.min("first_update").alias("first_update"),
        F.max("last_update").alias("last_update"),
    )


def top_per_key(df: DataFrame, key: str, value: str, k: int = 10) -> DataFrame:
    """The k most frequent values of each key, ties by value. The rank filter runs per task before the shuffle by key (window group
    limit), so a hot key sends at most k rows per task."""
    n = df.where(F.col(value).isNotNull()).groupBy(F.col(key).alias(key), F.col(value).alias(value)).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(key).orderBy(F.desc("n"), F.asc(value))
    return n.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def rank_per_key(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Standard rank of every distinct time of a key within the key, ties sharing one rank: (key, ts, n, rank). Null times are left out.

    No task ever sorts the rows of a hot key: rows collapse to (key, time) counts, these to counts per second, hour and day, and a rank is
    the sum over earlier days, over earlier hours of the day, seconds of the hour and times of the second. A window holds the days of a
    key, 24 hours, 3,600 seconds or the distinct times of one second of one key."""
    times = df.where(F.col(ts).isNotNull()).groupBy(F.col(key).alias(key), F.col(ts).alias(ts)).agg(F.count(F.lit(1)).alias("n"))
    levels = ["_day", "_hour", "_second"]
    out = times.select("*", *[F.date_trunc(x[1:], ts).alias(x) for x in levels]).withColumn("rank", F.lit(1).cast("long"))
    within = Window.partitionBy(key, "_second").orderBy(ts).rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumn("rank", F.col("rank") + F.coalesce(F.sum("n").over(within), F.lit(0)))
    sums = times.groupBy(key, F.date_trunc("second", ts).alias("_second")).agg(F.sum("n").alias("n"))
    for level, above in (("_second", "_hour"), ("_hour", "_day"), ("_day", None)):
        names = [key, level] if above is None else [key, above, level]
        if above is not None:
            sums = sums.withColumn(above, F.date_trunc(above[1:], level))
        w = Window.partitionBy(*names[:-1]).orderBy(level).rowsBetween(Window.unboundedPreceding, -1)
        earlier = sums.select(F.col(key).alias("_k"), F.col(level).alias("_l"), F.coalesce(F.sum("n").over(w), F.lit(0)).alias("_before"))
        out = out.join(earlier, F.col(key).eqNullSafe(F.col("_k")) & (F.col(level) == F.col("_l"))).withColumn("rank", F.col("rank") + F.col("_before")).drop("_k", "_l", "_before")
        if above is not None:
            sums = sums.groupBy(key, above).agg(F.sum("n").alias("n"))
    return out.select(key, ts, "n", "rank")


#: `join_split` looks for hot keys among one in SAMPLED rows, drawn at random.
SAMPLED = 16


def sampled(df: DataFrame) -> DataFrame:
    return df.where(F.rand(7) * SAMPLED < 1)


def join_split(left: DataFrame, right: DataFrame, on: str, unique: bool = False, hot: int = 1000, least: int = 100_000, look: list[DataFrame] | None = None) -> DataFrame:
    """Inner join on a column that may repeat on both sides, and in which one key may hold a third of all rows.

    A sample of the rows tells which keys have more than 1/hot of the rows of a side and more than about `least` rows (fewer than
    2 * hot keys, which are broadcast). Such a key is spread over a grid of g x g cells, g the square root of its share times hot: a left
    row goes into one row of the grid and a right row into one column of it, so a task meets 1/g of either side. With unique=True, for a
    right side that has each key once, left rows spread over the share times hot cells and the right row is repeated in each. The sample
    decides on the spreading alone; the result is that of a plain join. Null keys meet nothing. Sides that are dear to compute are looked
    at through `look`, cheaper samples of their rows (see `sampled`)."""

    def seen(df: DataFrame) -> tuple[DataFrame, int, int]:
        c = df.groupBy(F.col(on).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
        r = c.where("_k is not null").agg(F.sum("_n").alias("t"), F.max("_n").alias("m")).head()
        return c, r["t"] or 0, r["m"] or 0

    heavy = None
    for df in look or map(sampled, (left,) if unique else (left, right)):
        c, total, most = seen(df)
        if most * SAMPLED > least and most * hot > total:
            own = c.where((F.col("_n") * hot > total) & (F.col("_n") * SAMPLED > least) & F.col("_k").isNotNull())
            cells = F.col("_n") * F.lit(hot) / F.lit(total)
            own = own.select("_k", F.ceil(cells if unique else F.sqrt(cells)).cast("int").alias("_g"))
            heavy = own if heavy is None else heavy.unionByName(own)
    if heavy is None:
        return left.join(right, on)
    grid = F.broadcast(heavy.groupBy("_k").agg(F.max("_g").alias("_g")))

    def spread(df: DataFrame, mine: str, other: str) -> DataFrame:
        own = F.pmod(F.xxhash64(*df.columns), F.col("_g")).cast("int")
        if unique:
            at = F.explode(F.sequence(F.lit(0), F.col("_g") - 1)) if df is right else own
            return df.join(grid, df[on] == grid["_k"], "left").withColumn("_g", F.coalesce("_g", F.lit(1))).select(*df.columns, at.alias("_row"), F.lit(0).alias("_col"))
        d = df.join(grid, df[on] == grid["_k"], "left").withColumn("_g", F.coalesce("_g", F.lit(1)))
        return d.select(*df.columns, own.alias(mine), F.explode(F.sequence(F.lit(0), F.col("_g") - 1)).alias(other))

    return spread(left, "_row", "_col").join(spread(right, "_col", "_row"), [on, "_row", "_col"]).drop("_row", "_col")


def meet_within(df: DataFrame, key: str, count: str, cols: list[str], limit: int = 1000) -> DataFrame:
    """Self join of df by key as (key, a_*, b_*), where `count` is the number of rows of the key.

    A key of more than `limit` rows is split: its left rows are spread by a hash of `cols` over ceil(count / limit) salts and its right
    rows are repeated once per salt, so a task meets at most about `limit` left rows of a key with the key's right rows. Keys below the
    limit are neither split nor repeated. The caller filters the order it wants, such as a_x < b_x."""
    salts = F.ceil(F.col(count) / F.lit(limit)).cast("int")
    base = df.withColumn("_salts", salts)
    left = base.select(key, F.pmod(F.xxhash64(*cols), F.col("_salts")).cast("int").alias("_salt"), *[F.col(c).alias("a_" + c) for c in cols])
    right = base.select(key, F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt"), *[F.col(c).alias("b_" + c) for c in cols])
    return left.join(right, [key, "_salt"]).drop("_salt")
