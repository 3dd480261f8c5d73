"""The queries of the ten problems over the tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codexmill.llm import canonical, components, consensus, contamination, langid, mojibake, names, neardup, packing, residue
from codexmill.session import written


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return components.merge_groups(table(spark, d, "decisions"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    groups = components.merge_groups(table(spark, d, "decisions"))
    return consensus.clear_survivors(groups, table(spark, d, "book_evidence"), table(spark, d, "localizations"))


def p3_values(spark: SparkSession, d: str) -> DataFrame:
    groups = components.merge_groups(table(spark, d, "decisions"))
    return consensus.surviving_values(groups, table(spark, d, "book_evidence"), table(spark, d, "localizations"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return names.same_entities(table(spark, d, "attributions"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.look_alikes(table(spark, d, "localizations"), table(spark, d, "aliases"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.residue_ids(table(spark, d, "localizations"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    localizations = table(spark, d, "localizations")
    return langid.mislabelled(localizations, written(residue.residue_ids(localizations), "residue"))


def p6_segments(spark: SparkSession, d: str) -> DataFrame:
    localizations = table(spark, d, "localizations")
    return langid.identified(localizations, written(residue.residue_ids(localizations), "residue"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    localizations = table(spark, d, "localizations")
    return neardup.near_duplicates(localizations, written(residue.residue_ids(localizations), "residue"))


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.containers(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return contamination.leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.garbled(table(spark, d, "documents"), restore=False).select("doc_id").distinct()


def p10_restored(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.garbled(table(spark, d, "documents"))


def p7_equal(spark: SparkSession, d: str) -> DataFrame:
    """The near duplicates whose summaries are stored alike, residue included: a lower bound that SQL can state."""
    localizations = table(spark, d, "localizations")
    pairs = neardup.near_duplicates(localizations)
    last = localizations.where("locId is not null").groupBy("locId").agg(F.max_by("summary", F.struct("capturedAt", "updatedAt")).alias("summary")).where("length(trim(summary)) >= 20")
    a, b = last.toDF("locIdA", "sa"), last.toDF("locIdB", "sb")
    return pairs.join(a, "locIdA").join(b, "locIdB").where("sa = sb").select("locIdA", "locIdB")


def p8_invariants(spark: SparkSession, d: str) -> DataFrame:
    """What holds for any right packing, in one row: all documents placed with all their characters, no container too full, nothing split in vain."""
    placed = written(packing.containers(table(spark, d, "documents")), "placed")
    per = placed.groupBy("doc_id").agg(F.count("*").alias("pieces"), F.countDistinct("piece").alias("kinds"), F.sum(F.col("end") - F.col("begin")).alias("characters"), F.sum("tokens").alias("tokens"))
    of = per.agg(F.count("*").alias("documents"), F.sum("characters").alias("characters"), F.count_if((F.col("pieces") > 1) & (F.col("tokens") <= packing.CAPACITY // 2)).alias("split_in_vain"), F.count_if(F.col("pieces") != F.col("kinds")).alias("repeated"))
    full = placed.groupBy("container").agg(F.sum("tokens").alias("tokens")).agg(F.count_if(F.col("tokens") > packing.CAPACITY).alias("too_full"), F.coalesce(F.round(F.sum("tokens") / (F.count("*") * packing.CAPACITY), 2) >= 0.98, F.lit(False)).alias("packed"))
    one = lambda df: df.withColumn("k", F.lit(1))
    return one(of).join(one(full), "k").drop("k")


def p9_verbatim(spark: SparkSession, d: str) -> DataFrame:
    """The leaks whose item stands in the document as it is stored: a lower bound that SQL can state."""
    documents, items = table(spark, d, "documents"), table(spark, d, "eval_items")
    found = contamination.leaks(documents, items).select("doc_id", "item_id")
    whole = found.join(documents.select("doc_id", "text"), "doc_id").join(items.select("item_id", F.col("text").alias("item")), "item_id")
    return whole.where(F.contains("text", "item")).select("doc_id", "item_id").distinct()


def p10_lost(spark: SparkSession, d: str) -> DataFrame:
    """The garbled documents that have lost characters outside of literal text: a lower bound that SQL can state."""
    documents = table(spark, d, "documents")
    found = mojibake.garbled(documents, restore=False).select("doc_id").distinct()
    return found.join(documents.where(F.contains("text", F.lit(mojibake.LOST)) & ~F.contains("text", F.lit("<code"))).select("doc_id"), "doc_id", "left_semi")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p2_found, p3_found, p3_values, p4_found, p5_found, p6_found, p6_segments, p7_found, p7_equal, p8_containers, p8_invariants, p9_found, p9_verbatim, p10_found, p10_restored, p10_lost)}
