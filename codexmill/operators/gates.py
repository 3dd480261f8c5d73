"""Checks over groups of records: repeated texts, templates, uniform parts, samples of issues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexmill.operators.catalog import top_each


def repeated_text(rows: DataFrame, group: Sequence[str], form: Column, least: int = 3) -> DataFrame:
    """(group, form, n): texts that stand ``least`` times or more in a group; null and empty forms are no texts."""
    return rows.select(*group, form.alias("form")).where("form <> ''").groupBy(*group, "form").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def uniform(rows: DataFrame, group: Sequence[str], test: Column, least: int) -> DataFrame:
    """(group, n): groups of at least so many rows that all pass a test; a null result fails it."""
    return rows.groupBy(*group).agg(F.count("*").alias("n"), F.bool_and(F.coalesce(test, F.lit(False))).alias("all")).where(F.col("all") & (F.col("n") >= least)).select(*group, "n")


def issue_sample(issues: DataFrame, group: Sequence[str], order: Sequence[Column], most: int = 20) -> DataFrame:
    """The first issues of each group by a stated order; the bound is the feature of a sample."""
    return top_each(issues, group, order, most)


def flags(conditions: Sequence[tuple[str, Column]]) -> Column:
    """The names of the conditions that hold, in the order given."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in conditions]))


def violations(rules: Sequence[tuple[str, Column]]) -> Column:
    """The codes of broken rules in order; the first is ``try_element_at(x, 1)``. A rule that is null counts as broken."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules]))
