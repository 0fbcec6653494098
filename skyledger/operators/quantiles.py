"""Exact quantiles of large groups without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.operators.running import with_running_total


def value_counts(df: DataFrame, group: str, value: str) -> DataFrame:
    """How often each value occurs in each group; nulls are left out."""
    return df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("n"))


def ranked_counts(df: DataFrame, group: str, value: str) -> DataFrame:
    """``value_counts`` with ``upto``, the number of values up to and with each one. It is
    checkpointed, so all that is made of it reads the data once."""
    return with_running_total(value_counts(df, group, value), "upto", "n", group, value)


def quantiles_of(ranked: DataFrame, group: str, value: str, probs: list[float]) -> DataFrame:
    """Linear-interpolated quantiles of ``ranked_counts``: ``(group, total, q0, q1, ...)``.

    The values at the wanted ranks are picked where they stand; only these, two for each
    group and quantile, come together.
    """
    totals = ranked.groupBy(group).agg(F.max("upto").alias("total"))
    positions = [f"(total - 1) * {float(p)}D" for p in probs]
    ends = ", ".join(f"floor({p}), ceil({p})" for p in positions)
    found = (
        ranked.join(totals, group)
        .selectExpr(group, value, "total", "upto", "upto - n AS before", f"array_distinct(array({ends})) AS ranks")
        .selectExpr(group, value, "total", "explode(filter(ranks, r -> r >= before AND r < upto)) AS rank")
        .groupBy(group, "total")
        .agg(F.expr(f"map_from_entries(collect_set(struct(rank, {value}))) AS at_rank"))
    )
    answers = [
        f"at_rank[floor({p})] + (at_rank[ceil({p})] - at_rank[floor({p})]) * ({p} - floor({p})) AS q{i}"
        for i, p in enumerate(positions)
    ]
    return found.selectExpr(group, "total", *answers)


def exact_quantiles(df: DataFrame, group: str, groups: list[str], value: str, probs: list[float]) -> DataFrame:
    """``quantiles_of`` the rows whose ``group`` is among ``groups``."""
    rows = df.where(F.col(group).isin(groups)).select(group, value)
    return quantiles_of(ranked_counts(rows, group, value), group, value, probs)
