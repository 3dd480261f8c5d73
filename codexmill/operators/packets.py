"""Packets: a few sources with what is needed to judge them, their ids derived from their content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codexmill.operators.catalog import top_each
from codexmill.operators.paging import parts, positions

MOST_SOURCES, MOST_CANDIDATES = 20, 50


def json_of(**fields: Column) -> Column:
    """A JSON object of columns with its keys in order, without blanks, nulls written out."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in sorted(fields.items())]), {"ignoreNullFields": "false"})


def packets(sources: DataFrame, order: Sequence[str], ident: str, run: str, most: int = MOST_SOURCES) -> DataFrame:
    """(part, sources, packetId): every ``most`` sources in an order, their ids sorted, with the hash of run, part and ids."""
    if not 1 <= most <= MOST_SOURCES:
        raise ValueError(f"a packet has 1 to {MOST_SOURCES} sources")
    each = parts(sources, order, most).groupBy("part").agg(F.array_sort(F.collect_list(ident)).alias("sources"))
    return each.withColumn("packetId", packet_id(run))


def packet_id(run: str) -> Column:
    return F.sha2(json_of(runId=F.lit(run), part=F.col("part"), sourceUnitIds=F.col("sources")), 256)


def input_hash() -> Column:
    return F.sha2(json_of(packetId=F.col("packetId"), candidates=F.col("candidates")), 256)


def ranked_candidates(packs: DataFrame, links: DataFrame, evidence: DataFrame, order: Sequence[Column], most: int = MOST_CANDIDATES) -> DataFrame:
    """(part, candidate, rank): the sources of each packet first, in order of id, then what they are linked to, best first, up to ``most``.

    ``links`` holds (source, candidate) and ``evidence`` (id and whatever
    ``order`` names). Candidates without evidence are left out; no candidate
    comes twice.
    """
    own = packs.select("part", F.posexplode("sources").alias("n", "candidate"), F.size("sources").alias("sources"))
    others = own.select("part", "sources", F.col("candidate").alias("source")).join(links, "source").select("part", "sources", "candidate").distinct()
    others = others.join(own.select("part", "candidate"), ["part", "candidate"], "left_anti").join(evidence.withColumnRenamed("id", "candidate"), "candidate")
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order, "candidate")) + F.col("sources")
    kept = others.withColumn("rank", place).where(F.col("rank") <= most).select("part", "candidate", "rank")
    return own.select("part", "candidate", (F.col("n") + 1).alias("rank")).unionByName(kept)


def ranked_by_group(packs: DataFrame, groups: DataFrame, evidence: DataFrame, order: Sequence[Column], most: int = MOST_CANDIDATES) -> DataFrame:
    """``ranked_candidates`` where units are linked by the groups that they share; ``groups`` holds (id, group).

    Only the first ``most`` units of a group are looked at: of those in a
    packet, no more are its own than it has places less for others, so that the
    rest of a group can't be among them. Units go by their place in ``order``
    until the end. Nulls are no group.
    """
    placed = positions(evidence, [*order, F.asc("id")], "place").select("id", "place")
    members = groups.where(F.col("group").isNotNull()).select("id", "group").distinct()
    firsts = top_each(members.join(placed, "id"), ["group"], [F.asc("place")], most).groupBy("group").agg(F.collect_list("place").alias("places"))
    own = packs.select("part", F.posexplode("sources").alias("n", "candidate"), F.size("sources").alias("sources"))
    met = own.select("part", F.col("candidate").alias("id")).join(members, "id").select("part", "group").distinct().join(firsts, "group")
    others = met.groupBy("part").agg(F.flatten(F.collect_list("places")).alias("places"))
    mine = own.select("part", "sources", F.col("candidate").alias("id")).join(placed, "id", "left").groupBy("part").agg(F.first("sources").alias("sources"), F.collect_list("place").alias("mine"))
    left = F.slice(F.array_sort(F.array_except("places", "mine")), F.lit(1), F.greatest(F.lit(0), F.lit(most) - F.col("sources")))
    kept = others.join(mine, "part").select("part", "sources", F.posexplode(left).alias("n", "place")).join(placed.withColumnRenamed("id", "candidate"), "place")
    return own.select("part", "candidate", (F.col("n") + 1).alias("rank")).unionByName(kept.select("part", "candidate", (F.col("n") + 1 + F.col("sources")).alias("rank")))


def review_packets(packs: DataFrame, candidates: DataFrame, signals: DataFrame) -> DataFrame:
    """(part, sources, packetId, candidates, signals, inputHash): whole packets.

    ``candidates`` comes from ``ranked_candidates``; ``signals`` holds (id,
    flags), of which a packet has a map for its sources.
    """
    listed = candidates.groupBy("part").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "candidate"))), lambda x: x["candidate"]).alias("candidates"))
    flagged = packs.select("part", F.explode("sources").alias("id")).join(signals, "id", "left").groupBy("part").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("id", F.coalesce("flags", F.array().cast("array<string>")))))).alias("signals"))
    whole = packs.join(listed, "part").join(flagged, "part")
    return whole.withColumn("inputHash", input_hash())


def packet_problems(whole: DataFrame, run: str) -> Column:
    """What is wrong with a packet as it stands: a source that is no candidate, or an id or hash that isn't that of its content."""
    return F.array_compact(
        F.array(
            F.when(F.size(F.array_except("sources", "candidates")) > 0, F.lit("source_not_candidate")),
            F.when(F.col("packetId") != packet_id(run), F.lit("packet_id")),
            F.when(F.col("inputHash") != input_hash(), F.lit("input_hash")),
        )
    )
