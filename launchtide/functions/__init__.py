from launchtide.functions.columns import (
    earliest,
    earliest_unless_null,
    month_of_path,
    within,
    yyyymm,
)

__all__ = ["earliest", "earliest_unless_null", "month_of_path", "within", "yyyymm"]
