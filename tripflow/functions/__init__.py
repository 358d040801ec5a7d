from tripflow.functions.expressions import (
    banded,
    elapsed_minutes,
    elapsed_whole_minutes,
    fee_total,
    guarded_ratio,
    split_part_at,
    to_type,
)
from tripflow.functions.udfs import square_udf

__all__ = [
    "banded", "elapsed_minutes", "elapsed_whole_minutes", "fee_total", "guarded_ratio",
    "split_part_at", "square_udf", "to_type",
]
