from launchtide.operators.devices import (
    device_lookup,
    earliest_launches,
    enrich,
    launched_models,
    launches,
)
from launchtide.operators.histogram import (
    combine_histograms,
    delta_histogram,
    delta_row_histogram,
    derive_bands,
)
from launchtide.operators.segments import (
    assign_segments,
    datamart_totals,
    distinct_users,
    segment_audit,
)
from launchtide.operators.sightings import earliest_sightings, sightings
from launchtide.operators.uptake import (
    first_device,
    first_rows,
    join_launches,
    launch_delta,
    non_negative,
)
from launchtide.operators.user_sets import code_users, count_user_sets, merge_user_sets, user_sets

__all__ = [
    "assign_segments",
    "code_users",
    "combine_histograms",
    "count_user_sets",
    "datamart_totals",
    "delta_histogram",
    "delta_row_histogram",
    "derive_bands",
    "device_lookup",
    "distinct_users",
    "earliest_launches",
    "earliest_sightings",
    "enrich",
    "first_device",
    "first_rows",
    "join_launches",
    "launch_delta",
    "launched_models",
    "launches",
    "merge_user_sets",
    "non_negative",
    "segment_audit",
    "sightings",
    "user_sets",
]
