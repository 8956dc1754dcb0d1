from launchtide.sinks.shared import kept, shared_path
from launchtide.sinks.writers import (
    write_datamart,
    write_deltas,
    write_histograms,
    write_report,
    write_user_sets,
)

__all__ = ["kept", "shared_path", "write_datamart", "write_deltas", "write_histograms", "write_report", "write_user_sets"]
