"""Rolling frames of the ``n`` preceding rows that spread a hot group over ordered buckets.

A plain window sends a whole group to one task.  Here rows are dealt by (group, bucket),
where the buckets are columns whose values rise with the window's order (a season, then
stretches of its rounds).  A row whose frame reaches back over its bucket's start takes the
missing values from the bucket's *halo*: the last ``n`` values of the group before it.
Halos come from the last ``n`` values of every bucket, passed on level by level: among the
buckets of one parent first (the ``n`` buckets before are enough, each holds a row), then
from the parent's own halo.  So no task sees more than one bucket's rows, one parent's
bucket ends, or one group's ends of the coarsest level, and the result is that of the plain
window, value by value in the same order.

The rows are dealt once: their windows and the bucket ends read the same exchange.  For that
both must read the same columns, so the ends carry a checksum of all of them; select the
columns needed before asking for frames.  The group travels in the key alone, so a consumer
that does not read it shares the exchange too.

Built-in functions only, lazy: no job runs while a frame is built.  NULL groups are groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY, VALUE, BEFORE = "__key", "__value", "__before"


def _bucket(level: int) -> str:
    return f"__b{level}"


def _key(by: list[str], level: int) -> Column:
    """Group and buckets down to ``level`` as one struct: equal also where parts are NULL."""
    return F.struct(*[F.col(c) for c in by], *[F.col(_bucket(k)) for k in range(level)])


def _last(values: Column, n: int) -> Column:
    return F.slice(values, F.greatest(F.size(values) - n + 1, F.lit(1)), F.lit(n))


def with_buckets(df: DataFrame, by: list[str], value: Column, buckets: list[Column]) -> DataFrame:
    """``df`` dealt by (group, buckets): with that key in place of the group's columns, and the
    value that the frames are over."""
    key = F.struct(*[F.col(c) for c in by], *[b.alias(_bucket(k)) for k, b in enumerate(buckets)])
    return df.withColumns({VALUE: value, KEY: key}).drop(*by).repartition(KEY)


def with_group(rows: DataFrame, by: list[str]) -> DataFrame:
    """The group's columns back from the key."""
    return rows.withColumns({c: F.col(f"{KEY}.{c}") for c in by})


def bucket_ends(rows: DataFrame, by: list[str], order: list[str], n: int, levels: int) -> DataFrame:
    """Group, buckets and, for every bucket of the finest level, its first and last ``n`` values:
    ``__starts`` and ``__ends``."""
    ordered = F.col("__ordered")
    ends = rows.groupBy(KEY).agg(F.sort_array(F.collect_list(F.struct(*order, F.col(VALUE)))).alias("__ordered"),
                                 F.bit_xor(F.xxhash64(*[c for c in rows.columns if c != KEY])).alias("__whole"))
    parts = [F.col(f"{KEY}.{c}").alias(c) for c in [*by, *[_bucket(k) for k in range(levels)]]]
    ends = ends.select(*parts, F.transform(F.slice(ordered, 1, n), lambda x: x[VALUE]).alias("__starts"),
                       F.transform(_last(ordered, n), lambda x: x[VALUE]).alias("__ends"), "__whole")
    return ends.withColumn("__ends", F.when(F.col("__whole").isNotNull(), F.col("__ends"))).drop("__whole")


def halos(ends: DataFrame, by: list[str], n: int, levels: int, *carried: str) -> DataFrame:
    """``KEY``, ``BEFORE`` and the columns ``carried`` on: per bucket the last ``n`` values of its
    group before it, oldest first.

    ``ends`` holds group, buckets and ``__ends`` of the finest level.
    """
    parent = [*by, *[_bucket(k) for k in range(levels - 1)]]
    own = _bucket(levels - 1)
    earlier = Window.partitionBy(*parent).orderBy(own).rowsBetween(-n, -1)
    siblings = _last(F.flatten(F.collect_list("__ends").over(earlier)), n)
    rows = ends.withColumn("__siblings", siblings)
    if levels == 1:
        return rows.select(_key(by, 1).alias(KEY), F.col("__siblings").alias(BEFORE), *carried)
    merged = F.sort_array(F.collect_list(F.struct(own, "__ends")))
    above = ends.groupBy(*parent).agg(_last(F.flatten(F.transform(merged, lambda x: x["__ends"])), n).alias("__ends"))
    above = halos(above, by, n, levels - 1).select(F.col(KEY).alias("__parent"), F.col(BEFORE).alias("__above"))
    joined = rows.withColumn("__up", _key(by, levels - 1)).join(above, F.col("__up") == F.col("__parent"))
    return joined.select(_key(by, levels).alias(KEY), _last(F.concat("__above", "__siblings"), n).alias(BEFORE), *carried)


def sums_of(values: Column, fields: list[str]) -> Column:
    """Per struct field its sum ``s`` and count ``n`` over an array in its order, NULLs left out:
    one fold for all fields."""
    start = F.struct(*[F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("n")).alias(f) for f in fields])

    def add(acc: Column, v: Column) -> Column:
        return F.struct(*[F.struct(
            (acc[f]["s"] + F.coalesce(v[f].cast("double"), F.lit(0.0))).alias("s"),
            (acc[f]["n"] + v[f].isNotNull().cast("int")).alias("n")).alias(f) for f in fields])

    return F.aggregate(values, start, add)


def rolling_mean(df: DataFrame, measures: dict[str, Column], by: list[str], order: list[str], n: int,
                 buckets: list[Column]) -> DataFrame:
    """Mean of each measure over the ``n`` preceding rows of the group (current row excluded).

    Equal to the window over (``by``, ``order``); ``buckets`` must rise with ``order``.
    """
    levels = len(buckets)
    rows = with_buckets(df, by, F.struct(*[c.alias(m) for m, c in measures.items()]), buckets)
    before = halos(bucket_ends(rows, by, order, n, levels), by, n, levels, "__starts")
    w = Window.partitionBy(KEY).orderBy(*order)
    frame = w.rowsBetween(-n, -1)
    # A frame that lies inside the bucket is the built-in mean; the first n rows of a bucket
    # put their few own predecessors, the bucket's first values, after the halo's last ones.
    rows = rows.withColumns({"__at": F.row_number().over(w),
                             **{m: F.avg(F.col(f"{VALUE}.{m}")).over(frame) for m in measures}})
    joined = rows.join(before, KEY)
    whole = _last(F.concat(BEFORE, F.slice("__starts", F.lit(1), F.col("__at") - 1)), n)
    joined = joined.withColumn("__sums", F.when(F.col("__at") <= n, sums_of(whole, list(measures))))
    total = {m: F.col(f"__sums.{m}") for m in measures}
    means = {m: F.when(F.col("__at") > n, F.col(m)).when(t["n"] > 0, t["s"] / t["n"]) for m, t in total.items()}
    found = with_group(joined.withColumns(means), by)
    return found.select(*df.columns, *measures)


def rolling_mean_of_events(df: DataFrame, measures: dict[str, Column], by: list[str], event: list[str], n: int,
                           buckets: list[Column]) -> DataFrame:
    """Mean over all rows of the group's ``n`` previous events (groups of equal ``event``).

    Rows are pre-aggregated to sums and counts per event, the halo frames run over events
    and the means join back, so the rows of an event never meet beyond their partial sums.
    """
    levels = len(buckets)
    sums = [F.struct(F.sum(c.cast("double")).alias("s"), F.count(c).alias("n")).alias(m) for m, c in measures.items()]
    events = with_buckets(df.groupBy(*by, *event).agg(F.struct(*sums).alias("__sums")), by, F.col("__sums"), buckets)
    before = halos(bucket_ends(events, by, event, n, levels), by, n, levels)
    w = Window.partitionBy(KEY).orderBy(*event)
    local = events.withColumn("__local", F.collect_list(VALUE).over(w.rowsBetween(-n, -1))).join(before, KEY)
    frame = _last(F.concat(BEFORE, "__local"), n)

    def mean(m: str) -> Column:
        total = F.aggregate(frame, F.lit(0.0), lambda a, e: a + F.coalesce(e[m]["s"], F.lit(0.0)))
        count = F.aggregate(frame, F.lit(0).cast("long"), lambda a, e: a + e[m]["n"])
        return F.when(count > 0, total / count)

    found = with_group(local, by).select(F.struct(*by, *event).alias("__event"), *[mean(m).alias(m) for m in measures])
    return df.withColumn("__event", F.struct(*by, *event)).join(found, "__event").drop("__event")
