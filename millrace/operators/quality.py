"""Named row constraints."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Constraint:
    """A named SQL predicate that every kept row satisfies."""

    name: str
    predicate: str

    def holds(self) -> Column:
        """True or false, never null: a predicate without an answer counts as violated."""
        return F.coalesce(F.expr(self.predicate), F.lit(False))

    def violations(self) -> Column:
        return F.coalesce(F.sum(F.when(self.holds(), 0).otherwise(1)), F.lit(0)).cast("bigint")


def drop_violations(df: DataFrame, constraints: Sequence[Constraint]) -> DataFrame:
    """Keep the rows that satisfy all constraints.

    A filter drops rows whose predicate is null by itself, so the bare predicates stand in the plan and
    those a scan understands are pushed to it.
    """
    for constraint in constraints:
        df = df.filter(F.expr(constraint.predicate))
    return df


def count_violations(df: DataFrame, constraints: Sequence[Constraint]) -> DataFrame:
    """One row per constraint with its number of violating rows, from one pass over the input."""
    totals = df.agg(*(c.violations().alias(c.name) for c in constraints))
    pairs = [
        F.struct(F.lit(c.name).alias("constraint_name"), F.col(c.name).alias("violations"))
        for c in constraints
    ]
    return totals.select(F.inline(F.array(*pairs)))


def observe_violations(
    df: DataFrame, constraints: Sequence[Constraint], observation: Observation | str
) -> DataFrame:
    """Count violations while the rows pass by; the counts are known once an action has run.

    Pass an ``Observation`` in batch and a name on a stream, where each batch's counts appear in the
    query's progress.
    """
    return df.observe(observation, *(c.violations().alias(c.name) for c in constraints))
