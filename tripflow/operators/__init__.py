from tripflow.operators.drift import align_and_union, detect_family, read_drifting, read_families, unify_types
from tripflow.operators.grouping import collect_values, first_per_key, word_counts
from tripflow.operators.histogram import column_histograms, numeric_columns
from tripflow.operators.joins import attach_per_key, enrich_zones, is_small, outer_join
from tripflow.operators.ordered import Key, number_rows, rank_rows, running_total, sort_rows, with_total
from tripflow.operators.quality import quality_gate, with_positive_duration
from tripflow.operators.reuse import reused
from tripflow.operators.skew import has_hot_group

__all__ = [
    "Key", "align_and_union", "attach_per_key", "collect_values", "column_histograms", "detect_family",
    "enrich_zones", "first_per_key", "has_hot_group", "is_small", "number_rows", "numeric_columns", "outer_join",
    "quality_gate", "rank_rows", "read_drifting", "read_families", "reused", "running_total", "sort_rows",
    "unify_types", "with_positive_duration", "with_total", "word_counts",
]
