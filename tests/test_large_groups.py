"""Queries over books whose titles all begin alike, so that their pairs are too many to be made."""

import random
import time

import pytest
from pyspark.sql import functions as F

from codexmill import queries
from codexmill.operators import packets

N = 20_000


@pytest.fixture(scope="module")
def alike(spark, tmp_path_factory):
    """20,000 Chinese books, one for each minute of two weeks from 2024-09-01."""
    folder = str(tmp_path_factory.mktemp("alike"))
    made = spark.range(N).select(F.format_string("u%05d", "id").alias("id"), F.format_string("2024-09-%02dT%02d:%02d:00Z", (F.col("id") / 1440 + 1).cast("int"), (F.col("id") % 1440 / 60).cast("int"), F.col("id") % 60).alias("createdAt"))
    made.select("id", "createdAt", F.array(F.lit("zh")).alias("localizationLanguages")).write.parquet(f"{folder}/book_evidence.parquet")
    made.select(F.col("id").alias("unitId"), F.concat(F.lit("重返山"), F.right("id", F.lit(5))).alias("title"), F.lit(None).cast("string").alias("summary"), F.lit(None).cast("string").alias("description")).write.parquet(f"{folder}/localizations.parquet")
    return folder


def test_evidence_page(spark, alike):
    began = time.monotonic()
    got = queries.queries()["evidence_page"](spark, alike).select("source", "unit", "rank").collect()
    assert time.monotonic() - began < 60
    # the first book is as old as the cursor, but its id comes behind it
    want = {(f"u{i:05d}", f"u{i:05d}", 0) for i in range(64)} | {(f"u{i:05d}", f"u{c:05d}", k) for i in range(64) for k, c in enumerate([c for c in range(6) if c != i][:5], 1)}
    assert {tuple(r) for r in got} == want


def test_review_packets(spark, alike):
    began = time.monotonic()
    got = queries.queries()["review_packets"](spark, alike).select("part", "n", "problems").collect()
    assert time.monotonic() - began < 120
    assert sorted(tuple(r) for r in got) == [(k, 50, "") for k in range(N // 20)]


def test_groups_give_what_their_links_give(spark):
    rng = random.Random(5)
    groups = spark.createDataFrame([(f"s{i:03d}", rng.choice(["a", "a", "b", "c", None]), ) for i in range(150) for _ in range(rng.randint(0, 2))], "id string, group string")
    facts = spark.createDataFrame([(f"s{i:03d}", rng.choice([1, 2, None]), rng.choice([7, 8, None])) for i in range(140)], "id string, q int, t int")
    packs = packets.packets(spark.createDataFrame([(i, f"s{i * 2:03d}") for i in range(75)], "t int, id string"), ["t", "id"], "id", "r", 4)
    links = groups.withColumnRenamed("id", "source").join(groups.withColumnRenamed("id", "candidate"), "group").where("source <> candidate")
    order = [F.desc("q"), F.asc_nulls_last("t")]
    for most in (2, 4, 6, 50):
        want = packets.ranked_candidates(packs, links, facts, order, most).collect()
        assert sorted(tuple(r) for r in packets.ranked_by_group(packs, groups, facts, order, most).collect()) == sorted(tuple(r) for r in want)
