"""Reusable DataFrame operators."""

from .dedup import latest_per_key
from .fill import forward_fill
from .joins import broadcast_if_small, join_dimension
from .topk import top1_per_group
from .twolevel import peak_valley, sum_of_member_max

__all__ = ["latest_per_key", "forward_fill", "broadcast_if_small", "join_dimension",
           "top1_per_group", "peak_valley", "sum_of_member_max"]
