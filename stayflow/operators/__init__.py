"""DataFrame -> DataFrame operators, parameterised by column names."""

from stayflow.operators.asof import asof_join  # noqa: F401
from stayflow.operators.dedupe import dedupe, latest_per_key  # noqa: F401
from stayflow.operators.distinct import dense_ids, distinct_counts, distinct_state, merge_states  # noqa: F401
from stayflow.operators.entity import entity_universe, orphans, reconstruct_entity  # noqa: F401
from stayflow.operators.flatten import flatten_json_array  # noqa: F401
from stayflow.operators.intervals import interval_join, validity  # noqa: F401
from stayflow.operators.ranking import (  # noqa: F401
    grand_total, rank_with_running_share, share_of_partition, top_k_share,
)
from stayflow.operators.selection import exact_percentile  # noqa: F401
from stayflow.operators.spans import censor_flags, events_to_spans  # noqa: F401
from stayflow.operators.timeline import daily_grid, day_segment, islands, with_next  # noqa: F401
from stayflow.operators.union import flag_branches  # noqa: F401
from stayflow.operators.vocab import vocabulary_drift, vocabulary_pivot  # noqa: F401
