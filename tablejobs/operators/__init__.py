from tablejobs.operators.aggregates import cond_count_distinct, flag_by_category, two_level_mean
from tablejobs.operators.joins import (
    anti_in,
    join_null_safe,
    lookup_constants,
    semi_in,
    star_except,
    star_join,
    sum_after_last,
)
from tablejobs.operators.nested import flatten, lines_json, nest_lines
from tablejobs.operators.pivoting import pivot_agg, unpivot
from tablejobs.operators.prefix import prefix_sums
from tablejobs.operators.quantiles import exact_quantiles, quartile_classes, quartiles
from tablejobs.operators.ranking import partition_sum, ratio_to_subtotal, top_k_per_group, top_names
from tablejobs.operators.sampling import hash_fraction, hash_sample, hash_split

__all__ = [
    "anti_in",
    "cond_count_distinct",
    "exact_quantiles",
    "flag_by_category",
    "flatten",
    "hash_fraction",
    "hash_sample",
    "hash_split",
    "join_null_safe",
    "lines_json",
    "lookup_constants",
    "nest_lines",
    "partition_sum",
    "pivot_agg",
    "prefix_sums",
    "quartile_classes",
    "quartiles",
    "ratio_to_subtotal",
    "semi_in",
    "star_except",
    "star_join",
    "sum_after_last",
    "top_k_per_group",
    "top_names",
    "two_level_mean",
    "unpivot",
]
