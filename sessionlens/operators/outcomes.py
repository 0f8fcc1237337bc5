"""Outcomes after an intervention.

For every entity (company): how many of its outcomes (opportunities) closed
on or after each of its interventions (research presentations), split by
result and type.  The original joins accounts -> opportunities ->
interventions and sums CASE expressions over the fan-out, so an
opportunity counts once per intervention row of its company.

The same sums are computed from two pre-aggregates: opportunities counted
per (company, close date) with one count per measure, interventions
counted per (company, date).  Both are laid on one calendar per company and
a running sum over its dates gives each date's number of interventions so
far, so the work is linear in dates.  Both pre-aggregates combine map-side:
a company holding a third of all rows still ships one partial row per
(company, date) per task, and its calendar has one row per distinct date.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def outcomes_after(entities: DataFrame, outcomes: DataFrame, interventions: DataFrame,
                   measures: Mapping[str, Column], *,
                   entity_col: str = "main_company_identifier", link_col: str = "account_id",
                   outcome_date: Column | None = None, intervention_date: str = "deck_presented_date"
                   ) -> DataFrame:
    """One row per entity value with one bigint count per measure.

    ``measures``: output name -> boolean Column over outcome columns (the
    date test is added here).  Entities without outcomes or interventions
    get zeros; a NULL intervention date never counts.
    """
    od = outcome_date if outcome_date is not None else F.to_date("close_date")
    ents = entities.select(entity_col, link_col)
    meas = {name: F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).alias(f"_n_{name}")
            for name, cond in measures.items()}
    per_date = (ents.join(outcomes.withColumn("_odate", od), link_col, "inner")
                .where(F.col(entity_col).isNotNull() & F.col("_odate").isNotNull())
                .groupBy(entity_col, "_odate")
                .agg(*meas.values()))
    ivs = (interventions.where(F.col(entity_col).isNotNull() & F.col(intervention_date).isNotNull())
           .groupBy(F.col(entity_col).alias("_ent"), F.col(intervention_date).alias("_idate"))
           .agg(F.count(F.lit(1)).alias("_m")))
    # One row per (entity, date) with what happened on it; each date's outcomes
    # count once per intervention up to that date, a running sum over dates.
    zero = F.lit(0).cast("bigint")
    days = (per_date.withColumn("_m", zero)
            .unionByName(ivs.select(F.col("_ent").alias(entity_col), F.col("_idate").alias("_odate"),
                                    *[zero.alias(f"_n_{name}") for name in measures], "_m"))
            .groupBy(entity_col, "_odate")
            .agg(F.sum("_m").alias("_m"), *[F.sum(f"_n_{name}").alias(f"_n_{name}") for name in measures]))
    until = Window.partitionBy(entity_col).orderBy("_odate").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = days.withColumn("_seen", F.sum("_m").over(until)).groupBy(F.col(entity_col).alias("_sum_ent")).agg(
        *[F.sum(F.col(f"_n_{name}") * F.col("_seen")).alias(f"_s_{name}") for name in measures])
    all_entities = entities.select(entity_col).distinct()
    out = all_entities.join(sums, F.col(entity_col).eqNullSafe(F.col("_sum_ent")), "left")
    return out.select(entity_col, *[F.coalesce(F.col(f"_s_{name}"), F.lit(0)).cast("bigint").alias(name)
                                    for name in measures])


def research_measures() -> dict[str, Column]:
    """Measures of the research-effects script: closed, won, lost, renewals
    won and new business won after the presentation."""
    won = F.col("is_opp_won") == F.lit(True)
    lost = F.col("is_opp_won") == F.lit(False)
    return {
        "total_opps_closed_after_deck_delivered": F.lit(True),
        "total_opps_won_after_deck_delivered": won,
        "total_opps_lost_after_deck_delivered": lost,
        "total_renewal_won_after_deck_delivered": won & (F.col("type") == "Renewal"),
        "total_new_opps_won_after_deck_delivered": won & ((F.col("type") == "New") | (F.col("type") == "New Logo")),
    }
