from lakekit.operators.aggregate import count_by, order_desc, rollup_sum, sum_by, top_k, top_sum
from lakekit.operators.joins import (
    join_dim,
    join_literal,
    unmatched,
)

__all__ = [
    "count_by",
    "join_dim",
    "join_literal",
    "order_desc",
    "rollup_sum",
    "sum_by",
    "top_k",
    "top_sum",
    "unmatched",
]
