"""How many links begin after an event, without joining events to links.

The identity join repeats an event once per link whose bound is later.  Rollups
and milestones only need how often an event is repeated, so no product has to
be built: events and links of a user are laid on one time line, and each event
takes the number of links after it.  A user with E events and L links costs
E + L rows.

The time line is cut into slices.  Within a slice (one user, one slice of time)
a window walks events and links from the latest to the earliest; the links of
later slices are a running sum over one row per user and slice.  So a user who
holds a third of all events is spread over as many tasks as there are slices,
and event rows are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.operators.joins import row_hash

#: Microseconds of a slice.
SLICE = 3_600_000_000
#: Groups that rows without a user or a time are dealt to.
SPREAD = 4096


def _micros(t: Column) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, t.cast("timestamp_ntz"))


def later_link_counts(events: DataFrame, links: DataFrame, *, event_key: str, link_key: str, time_col: str,
                      bound_col: str, out_col: str = "n_links", slice_micros: int = SLICE) -> DataFrame:
    """The event rows and, as ``out_col``, the number of link rows of the same key (compared as text)
    whose bound is strictly later.

    0 for an event without a key or a time, or whose key has no later link; links without a key or a bound count
    for none.  Repeated event rows stay, repeated link rows count each.
    """
    start = F.floor(F.col("_at") / F.lit(slice_micros)).cast("long")
    ev = (events.withColumn("_key", F.col(event_key).cast("string")).withColumn("_at", _micros(F.col(time_col)))
          .withColumn("_slice", start))
    lost = F.col("_key").isNull() | F.col("_at").isNull()
    # rows that no link can follow get groups of their own, by their content
    ev = ev.withColumn("_spread", F.when(lost, F.pmod(row_hash(events), F.lit(SPREAD)) + 1).otherwise(F.lit(0)))
    bounds = (links.where(F.col(link_key).isNotNull() & F.col(bound_col).isNotNull())
              .groupBy(F.col(link_key).cast("string").alias("_key"), _micros(F.col(bound_col)).alias("_at"))
              .agg(F.count(F.lit(1)).alias("_n")).withColumn("_slice", start))
    marks = ev.where(~lost).select("_key", "_slice", F.lit(0).cast("long").alias("_n")).distinct()
    per_slice = marks.unionByName(bounds.select("_key", "_slice", "_n")).groupBy("_key", "_slice").agg(F.sum("_n").alias("_n"))
    after = Window.partitionBy("_key").orderBy(F.col("_slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    per_slice = (per_slice.select("_key", "_slice", F.sum("_n").over(after).alias("_later"))
                 .where(F.col("_later") > 0).withColumn("_spread", F.lit(0).cast("long")))
    # at equal times events come first, so that only strictly later links are behind them
    walk = (Window.partitionBy("_key", "_slice", "_spread").orderBy(F.col("_at").desc(), F.col("_is_link"))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    line = (ev.withColumn("_is_link", F.lit(0))
            .unionByName(bounds.select("_key", "_at", "_slice", "_n", F.lit(1).alias("_is_link"),
                                       F.lit(0).cast("long").alias("_spread")), allowMissingColumns=True))
    walked = line.withColumn("_here", F.sum("_n").over(walk)).where(F.col("_is_link") == 0)
    out = walked.join(per_slice, ["_key", "_slice", "_spread"], "left")
    total = F.coalesce(F.col("_here"), F.lit(0)) + F.coalesce(F.col("_later"), F.lit(0))
    return out.select(*[F.col(f"`{c}`") for c in events.columns], total.alias(out_col))
