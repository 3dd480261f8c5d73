"""Citations against stored evidence, and the indexes that link claims to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cited(decisions: DataFrame, keys: list[str], citations: str = "citations") -> DataFrame:
    """(keys, place, unitId, field, excerpt): one row for each citation, with its place from 0."""
    return decisions.select(*keys, F.posexplode(citations).alias("place", "c")).select(*keys, "place", "c.unitId", "c.field", "c.excerpt")


def supported(citations: DataFrame, evidence: DataFrame, keys: list[str], normal) -> DataFrame:
    """(keys, place, found): whether the excerpt stands in a stored value of its unit and field.

    ``evidence`` holds (unitId, field, value); ``normal`` brings both texts to
    one form. An empty excerpt is in nothing. The join is on the unit and the
    field, so only values that could support a citation meet it.
    """
    stored = evidence.select("unitId", "field", normal("value").alias("value")).where("value is not null").distinct()
    asked = citations.withColumn("want", normal("excerpt"))
    met = asked.join(stored, ["unitId", "field"], "left")
    hit = F.coalesce((F.col("want") != "") & F.contains("value", "want"), F.lit(False))
    return met.groupBy(*keys, "place").agg(F.bool_or(hit).alias("found"))


def distinct_citations(citations: DataFrame, keys: list[str], normal) -> DataFrame:
    """Citations without repeats and the place each has then: the order in which they first appear."""
    first = citations.groupBy(*keys, "unitId", "field", normal("excerpt").alias("form")).agg(F.min("place").alias("place"))
    return first.withColumn("index", F.row_number().over(Window.partitionBy(*keys).orderBy("place")) - 1)


def linkage(citations: Column, indexes: Column) -> Column:
    """What is wrong with the indexes of claims: 'missing' citation, 'repeated' index in one claim, 'unused' citation, or null.

    ``indexes`` is an array of one array of indexes for each claim.
    """
    n = F.coalesce(F.size(citations), F.lit(0))
    all_used = F.flatten(indexes)
    return (
        F.when(F.exists(all_used, lambda i: (i < 0) | (i >= n)), "missing")
        .when(F.exists(indexes, lambda x: F.size(F.array_distinct(x)) < F.size(x)), "repeated")
        .when(F.size(F.array_distinct(all_used)) < n, "unused")
    )


def subsets(rows: DataFrame, size: str, most: int = 12) -> DataFrame:
    """Rows times the non-empty proper subsets of their items as masks, larger subsets first, then greater masks.

    ``size`` items have ``2**size - 2`` of them, so sizes above ``most`` are an error and not an explosion.
    """
    n = F.col(size)
    bound = F.assert_true(n <= most, f"more than {most} items have too many subsets")
    masks = F.when(n >= 2, F.sequence(F.lit(1).cast("long"), F.expr(f"shiftleft(1L, {size})") - 2))
    return rows.where(bound.isNull()).withColumn("mask", F.explode(masks)).withColumn("items", F.bit_count("mask"))


def first_valid(rows: DataFrame, keys: list[str], size: str, valid: Column, most: int = 12) -> DataFrame:
    """(keys, mask, items): of each row the largest set of its items that is valid, the full set included, ties by the greater mask.

    ``valid`` is a column over ``mask``. Rows without a valid set have none. Only
    rows whose full set isn't valid are multiplied by their subsets.
    """
    full = rows.withColumn("mask", F.expr(f"shiftleft(1L, {size})") - 1).withColumn("items", F.col(size).cast("int"))
    sound, rest = full.where(valid), full.where(~F.coalesce(valid, F.lit(False))).drop("mask", "items")
    best = subsets(rest, size, most).where(valid).groupBy(*keys).agg(F.max(F.struct(F.col("items").cast("int").alias("items"), "mask")).alias("x"))
    return sound.select(*keys, "mask", "items").unionByName(best.select(*keys, "x.mask", "x.items"))
