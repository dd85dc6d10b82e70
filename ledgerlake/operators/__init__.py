from ledgerlake.operators.diff import compare_counts, diff_counts, keyed_diff, net_row_counts
from ledgerlake.operators.latest import keep_latest
from ledgerlake.operators.measures import MEASURES, group_measures
from ledgerlake.operators.ordered import in_stored_order, sorted_rows
from ledgerlake.operators.rank import rank_within_groups
from ledgerlake.operators.running import running_total
from ledgerlake.operators.topk import top_n_per_group, with_rank

__all__ = [
    "compare_counts", "diff_counts", "keyed_diff", "net_row_counts", "in_stored_order", "sorted_rows", "keep_latest", "MEASURES", "group_measures",
    "rank_within_groups", "running_total", "top_n_per_group", "with_rank",
]
