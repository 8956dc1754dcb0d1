from launchtide.plans.jobs import (
    audit_path,
    losses_path,
    publish,
    read_datamart,
    run_batch,
    run_monthly,
    run_monthly_segments,
)
from launchtide.plans.reach import distinct_histogram, read_codes, sets_path, stale_months, update_user_sets
from launchtide.plans.state import merge_first, read_state, run_incremental, state_months, update_state
from launchtide.plans.uptake import (
    batch_datamart,
    derived_datamart,
    first_devices,
    monthly_datamart,
    user_deltas,
)

__all__ = [
    "audit_path",
    "batch_datamart",
    "derived_datamart",
    "distinct_histogram",
    "first_devices",
    "monthly_datamart",
    "losses_path",
    "merge_first",
    "publish",
    "read_codes",
    "read_datamart",
    "read_state",
    "run_batch",
    "run_incremental",
    "run_monthly",
    "run_monthly_segments",
    "sets_path",
    "stale_months",
    "state_months",
    "update_state",
    "update_user_sets",
    "user_deltas",
]
