from marquee.operators.analytics import (
    filter_join_group_sum,
    filter_join_sort,
    group_count,
    join_group_avg,
    top_n,
)
from marquee.operators.shaping import (
    explode_bridge,
    fact_select,
    loss_names,
    orphan_rows,
    parse_json_arrays,
    with_losses,
)

__all__ = [
    "explode_bridge",
    "fact_select",
    "filter_join_group_sum",
    "filter_join_sort",
    "group_count",
    "join_group_avg",
    "loss_names",
    "orphan_rows",
    "parse_json_arrays",
    "top_n",
    "with_losses",
]
