"""Joining a large side, in which one key may own a large share, with one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_one_per_key(many: DataFrame, one: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on ``key`` so that adaptive execution can split a frequent key over many tasks.

    The planner broadcasts ``one`` by its own size check where it is small. Otherwise it
    sort-merges, and adaptive execution cuts an oversized partition of ``many`` into
    pieces, each read with the matching partition of ``one``. It does so only where both
    inputs come straight from a shuffle for this join. A side just aggregated by the same
    key would not, hence the rebalance: one more shuffle of the smaller side.
    """
    return many.join(one.hint("rebalance"), key, how)
