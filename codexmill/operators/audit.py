"""One report of all checks: issues of any kind counted by code, with a bounded sample of each."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexmill.operators.catalog import counters, top_each

MOST_IDS = 20


def united(issues: Mapping[str, tuple[DataFrame, Column | str]]) -> DataFrame:
    """(code, id): the issues of several checks, each a code with its rows and the column that names what is at fault."""
    each = [rows.select(F.lit(code).alias("code"), (F.col(c) if isinstance(c, str) else c).alias("id")) for code, (rows, c) in issues.items()]
    return reduce(DataFrame.unionByName, each)


def report(issues: DataFrame, most: int = MOST_IDS) -> DataFrame:
    """(code, n, ids): how many there are of each issue, and the first ids in order; the bound is the feature of a sample."""
    counts = issues.groupBy("code").agg(F.count("*").alias("n"))
    sample = top_each(issues.distinct(), ["code"], [F.asc_nulls_last("id")], most).groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return counts.join(sample, "code").select("code", "n", "ids")


def quality_report(rows: DataFrame, issues: DataFrame, dimensions: list[str]) -> DataFrame:
    """(kind, name, value, n): one table of issue counts and of counts by each dimension of the records."""
    found = issues.groupBy("code").agg(F.count("*").alias("n")).select(F.lit("issue").alias("kind"), F.col("code").alias("name"), F.lit(None).cast("string").alias("value"), "n")
    return found.unionByName(counters(rows, dimensions).select(F.lit("count").alias("kind"), F.col("dimension").alias("name"), "value", "n"))
