"""The page reader: sources behind a cursor, what they are linked to, and the evidence of both, in one plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexmill.operators.catalog import top_each
from codexmill.operators.paging import page


def evidence_page(sources: DataFrame, links: DataFrame | Callable[[DataFrame], DataFrame], evidence: DataFrame, time: str, ident: str, n: int, cursor: tuple | None = None, cutoff: object = None, most: int = 50) -> DataFrame:
    """(source, place, unit, rank, evidence): the next ``n`` sources and their candidates with the evidence of each.

    ``links`` holds (source, candidate, score), or is a function that makes them
    for the sources it is given, so that those of other sources aren't made; of
    a source the ``most`` best count, ties by id. ``evidence`` holds the id and any columns, which come as
    one struct. The row with rank 0 is the source itself. A candidate without
    evidence is left out, a source without is an error. Sources made after
    ``cutoff`` are no part of the population. All tables are read as they are
    when the plan starts, as files of a table don't change.
    """
    first = page(sources, time, ident, n, cursor, cutoff).select(F.col(ident).alias("source"), F.struct(time, ident).alias("place"))
    linked = links if isinstance(links, DataFrame) else links(first.select("source"))
    near = top_each(linked.join(first, "source"), ["source"], [F.desc("score"), F.asc("candidate")], most).select("source", "place", F.col("candidate").alias("unit"), "rank")
    wanted = first.select("source", "place", F.col("source").alias("unit"), F.lit(0).alias("rank")).unionByName(near)
    facts = F.struct(*[c for c in evidence.columns if c != "id"]).alias("evidence")
    met = wanted.join(evidence.select(F.col("id").alias("unit"), facts, F.lit(True).alias("known")), "unit", "left")
    missing = F.when(F.col("rank") > 0, F.lit(False)).otherwise(F.raise_error(F.concat(F.lit("a source has no evidence: "), F.col("source"))).cast("boolean"))
    return met.where(F.coalesce("known", missing)).select("source", "place", "unit", "rank", "evidence")
