"""What a plan does: its operators, what reaches the scans, and whether it stays in bounds."""

from __future__ import annotations

import re
import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

MOST_NODES = 256
# Names of physical operators that matter to cost.
WATCHED = ("Exchange", "BroadcastExchange", "BroadcastNestedLoopJoin", "CartesianProduct", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "Window", "TakeOrderedAndProject", "MapInArrow", "FlatMapGroupsInPandas", "ArrowEvalPython")


def nodes(df: DataFrame) -> list[tuple[int, str]]:
    """(depth, operator) of the physical plan, without literals or names of data."""
    text = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in text.split("\n"):
        m = re.match(r"([\s:+\-|]*)(?:\*\(\d+\)\s*)?([A-Z][A-Za-z]+)", line)
        if m:
            out.append((len(m.group(1)) // 3, m.group(2)))
    if len(out) > MOST_NODES:
        raise ValueError(f"a plan of more than {MOST_NODES} operators")
    return out


def profile(df: DataFrame) -> dict:
    """Counts of the watched operators, pushed filters and columns read."""
    text = df._jdf.queryExecution().executedPlan().toString()
    names = [n for _, n in nodes(df)]
    return {"operators": {n: names.count(n) for n in WATCHED if n in names}, "pushed": re.findall(r"PushedFilters: \[([^\]]*)\]", text), "read": re.findall(r"ReadSchema: (\S+)", text)}


def bounded(df: DataFrame) -> None:
    """An error where a plan multiplies its inputs."""
    bad = [n for _, n in nodes(df) if n in ("BroadcastNestedLoopJoin", "CartesianProduct")]
    if bad:
        raise AssertionError(f"the plan multiplies its inputs: {bad}")


def measured(df: DataFrame) -> list[dict]:
    """(depth, operator, rows, metrics) of each operator of a plan once it has run, from Spark's own metrics; no literals, no names of data.

    The rows are collected by the run, so this is for probes and not for results
    of any size. Operators that don't count rows have null.
    """
    jvm = df.sparkSession._jvm
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    out: list[dict] = []

    def walk(plan, depth: int) -> None:
        name = plan.nodeName().split(" ")[0]
        if name in ("AdaptiveSparkPlan",):
            return walk(plan.executedPlan(), depth)
        if len(out) >= MOST_NODES:
            raise ValueError(f"a plan of more than {MOST_NODES} operators")
        metrics = {str(k): int(v.value()) for k, v in dict(jvm.scala.jdk.javaapi.CollectionConverters.asJava(plan.metrics())).items()}
        out.append({"depth": depth, "operator": name, "rows": metrics.get("numOutputRows"), "metrics": {k: v for k, v in metrics.items() if v}})
        below = [plan.plan()] if of_kind(plan, "QueryStage") else list(jvm.scala.jdk.javaapi.CollectionConverters.asJava(plan.children()))
        for child in below:
            walk(child, depth + 1)

    walk(execution.executedPlan(), 0)
    return out


def of_kind(plan, kind: str) -> bool:
    """Whether an operator is of a kind, by the name of its class."""
    return kind in plan.getClass().getSimpleName()


def bounded_rows(df: DataFrame, most: int) -> list[dict]:
    """The measured operators of a plan; an error where one of them gives more than ``most`` rows."""
    found = measured(df)
    over = [(x["operator"], x["rows"]) for x in found if (x["rows"] or 0) > most]
    if over:
        raise AssertionError(f"more than {most} rows: {over}")
    return found


def probe(df: DataFrame) -> dict:
    """Time and size of a run that changes nothing, with the plan's profile and the rows of each operator."""
    began = time.monotonic()
    rows = df.count()
    return {"seconds": time.monotonic() - began, "rows": rows} | profile(df)


def doctor(spark: SparkSession, tables: Mapping[str, Sequence[str]], folder: str) -> list[tuple[str, str]]:
    """(table, problem) for tables that can't be read, have no rows or lack columns; empty where all is well."""
    out = []
    for name, columns in tables.items():
        try:
            rows = spark.read.parquet(f"{folder}/{name}.parquet")
            lacking = [c for c in columns if c not in rows.columns]
            if lacking:
                out.append((name, f"lacks {', '.join(lacking)}"))
            elif rows.isEmpty():
                out.append((name, "has no rows"))
        except Exception as e:  # noqa: BLE001 - whatever keeps a table from being read is what is asked for
            out.append((name, str(e).split("\n")[0][:200]))
    return out
