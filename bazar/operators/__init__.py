"""DataFrame operators the models are built from."""

from bazar.operators.joins import left_join_split, left_join_unique, lookup_join
from bazar.operators.profiling import distinct_values, null_counts, row_counts, rows_where
from bazar.operators.ranking import global_rank, global_row_number, row_positions
from bazar.operators.reduce import collapse, count_product, money_product, stack_by_key, sum_product
from bazar.operators.sorting import ordered, positions, top_k

__all__ = [
    "collapse",
    "count_product",
    "distinct_values",
    "global_rank",
    "global_row_number",
    "left_join_split",
    "left_join_unique",
    "lookup_join",
    "money_product",
    "null_counts",
    "ordered",
    "positions",
    "row_counts",
    "row_positions",
    "rows_where",
    "stack_by_key",
    "sum_product",
    "top_k",
]
