"""Rule-based classification (C9) and the campaign-intention lookup."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.functions.rule_index import classify_by_index
from sessionlens.functions.rules import Rule
from sessionlens.operators.joins import join_per_key


def campaign_intent(sessions: DataFrame, campaigns: DataFrame, retargeting: Iterable[str], *,
                    campaign_col: str = "utm_campaign", raw_campaign_col: str = "utm_campaign",
                    out_col: str = "ad_intention") -> DataFrame:
    """Attach the ad intention of each session's campaign.

    The lookup table is the set of *raw* campaign texts seen in
    ``campaigns`` (retargeting when its lowercase is listed, else
    prospecting); sessions look it up with their own ``campaign_col``.  A
    session whose campaign text never occurs raw gets NULL, as does a NULL
    campaign.  The lookup has one row per distinct campaign, so the join
    cannot fan out; its size is data-dependent, so the join strategy is left
    to AQE (broadcast once measured small, sort-merge otherwise).
    """
    lookup = (campaigns.select(F.col(raw_campaign_col).alias(campaign_col))
              .where(F.col(campaign_col).isNotNull())
              .distinct()
              .select(campaign_col,
                      F.when(F.lower(campaign_col).isin(list(retargeting)), F.lit("retargeting"))
                      .otherwise(F.lit("prospecting")).alias(out_col)))
    # A single campaign can carry a large share of all sessions: keep the
    # join splittable by AQE (operators/joins.py).
    joined = join_per_key(sessions, lookup, campaign_col)
    return joined.select(*sessions.columns, out_col)


def classify_columns(df: DataFrame, tables: Mapping[str, tuple[Sequence[Rule], str | None]]) -> DataFrame:
    """Add one column per rule table (first matching rule wins); large tables go through their rule index."""
    return classify_by_index(df, tables)
