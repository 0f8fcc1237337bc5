"""DataFrame operators: each takes DataFrames plus configuration and returns a DataFrame."""

from sessionlens.operators.classify import campaign_intent, classify_columns  # noqa: F401
from sessionlens.operators.funnel import (  # noqa: F401
    attach_step_flags, exclusive_attribution, funnel_flags, gate_funnel, happened_before,
    session_step_flags,
)
from sessionlens.operators.identity import bounded_identity_join, link_identities  # noqa: F401
from sessionlens.operators.joins import join_per_key, spread_key  # noqa: F401
from sessionlens.operators.milestones import milestone_durations, milestones  # noqa: F401
from sessionlens.operators.outcomes import outcomes_after, research_measures  # noqa: F401
from sessionlens.operators.refresh import (  # noqa: F401
    high_water_mark, incremental_refresh, merge_by_key, latest_partition, refresh_partitioned,
)
from sessionlens.operators.sessions import first_seen, session_base, session_rollup  # noqa: F401
