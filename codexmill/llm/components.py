"""Problem 1: pairwise matches into groups, on a two-dimensional grid of blocks.

Vertices are hashed into ``side`` blocks, so an edge falls into one of
``side * side`` cells. Each cell is united on its own (a local union-find over a
bounded number of edges); the representatives a vertex got in the cells of its
row and its column are then exchanged, the smallest becomes its parent, and the
others are linked to it. Those links are the edges of the next, smaller round,
whose grid has fewer cells. When the remaining edges fit one cell, that cell
ends the job. No round collects anything to the driver but edge counts.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexmill.session import drop_written, written

CELL_EDGES = 50_000


def unite(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest vertex linked with each of ``n`` vertices by the edges ``(a, b)``."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def _cell(pdf: pd.DataFrame) -> pd.DataFrame:
    ids, at = np.unique(np.concatenate([pdf["a"].to_numpy(object), pdf["b"].to_numpy(object)]).astype(str), return_inverse=True)
    half = len(pdf)
    root = unite(at[:half], at[half:], len(ids))
    return pd.DataFrame({"v": ids.astype(object), "root": ids[root].astype(object)})


def _round(edges: DataFrame, count: int, cell_edges: int) -> DataFrame:
    """(v, roots): what each vertex is called in the cells of its row and column."""
    # a mean of half the bound, so that only cells of hubs are cut
    side = 1 if count <= cell_edges else math.ceil(math.sqrt(2 * count / cell_edges))
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(side)).cast("int")
    cells = edges.select("a", "b", block("a").alias("i"), block("b").alias("j"))
    if side > 1:
        # a cell beyond the bound (the row of a hub) is cut into slices; any
        # slicing of the edges is right, as the exchange joins what it parts
        sizes = cells.groupBy("i", "j").count().where(F.col("count") > cell_edges)
        slices = sizes.select("i", "j", F.ceil(F.col("count") / cell_edges).cast("int").alias("cuts"))
        cells = cells.join(F.broadcast(slices), ["i", "j"], "left").withColumn("s", F.pmod(F.xxhash64("b", "a"), F.coalesce("cuts", F.lit(1))).cast("int"))
    else:
        cells = cells.withColumn("s", F.lit(0))
    local = cells.groupBy("i", "j", "s").applyInPandas(lambda pdf: _cell(pdf), "v string, root string")
    return local.groupBy("v").agg(F.array_sort(F.collect_set("root")).alias("roots"))


def connected(edges: DataFrame, a: str, b: str, cell_edges: int = CELL_EDGES) -> DataFrame:
    """(id, group): every vertex of an edge with the smallest id it is linked with.

    Edges with a null end and self links are no links; repeated edges and both
    directions count once; an empty table gives an empty result. Other columns,
    whatever their names, are ignored.
    """
    spark = edges.sparkSession
    left, right = F.col(a).cast("string"), F.col(b).cast("string")
    now = edges.select(F.least(left, right).alias("a"), F.greatest(left, right).alias("b"), (left.isNull() | right.isNull()).alias("open")).where("not open and a <> b").select("a", "b").distinct()
    now = written(now, "edges")
    levels: list[DataFrame] = []
    while (count := now.count()) or not levels:
        met = written(_round(now, count, cell_edges).select("v", F.element_at("roots", 1).alias("parent"), "roots"), "met")
        levels.append(met.select("v", "parent"))
        rest = met.where(F.size("roots") > 1).select("parent", F.explode("roots").alias("b")).where("b <> parent").select(F.col("parent").alias("a"), "b").distinct()
        drop_written(spark, now)
        now = written(rest, "edges")
    drop_written(spark, now)
    group = levels[-1].select(F.col("v"), F.col("parent").alias("top"))
    for level in reversed(levels[:-1]):
        # a parent may be shared by a large part of the rows: AQE splits such a
        # partition of the left side
        known = group.withColumnRenamed("v", "parent")
        group = level.join(known, "parent", "left").select("v", F.coalesce("top", "parent").alias("top"))
    return group.select(F.col("v").alias("id"), F.col("top").alias("group"))


def merge_groups(decisions: DataFrame, cell_edges: int = CELL_EDGES) -> DataFrame:
    """(unitId, groupId) of the ids that merge decisions connect; ids in lower case, without outer blanks.

    Decisions without a target, of another disposition or from a unit to itself
    link nothing. Repeated decisions count once.
    """
    key = lambda c: F.lower(F.trim(F.regexp_replace(c, r"^\s+|\s+$", "")))
    pairs = decisions.where(F.col("disposition") == "merge").select(key("sourceUnitId").alias("s"), key("targetUnitId").alias("t")).where("s <> '' and t <> ''")
    return connected(pairs, "s", "t", cell_edges).select(F.col("id").alias("unitId"), F.col("group").alias("groupId"))
