"""Sinks: files that appear whole or not at all, appended events, tables that are written once."""

from __future__ import annotations

import json
import os
import tempfile
from collections.abc import Sequence
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexmill.session import file_system


def _atomic(path: str, text: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    handle, temporary = tempfile.mkstemp(dir=Path(path).parent, prefix=".", suffix=".tmp")
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        os.replace(temporary, path)
    except BaseException:
        Path(temporary).unlink(missing_ok=True)
        raise


def write_json(path: str, value: object) -> None:
    """A JSON document that readers see whole."""
    _atomic(path, json.dumps(value, ensure_ascii=False, indent=2, allow_nan=False) + "\n")


def append_event(path: str, event: str, level: str = "info", **data: object) -> None:
    """One line of an event log; a single write to a file opened for appending."""
    if level not in ("debug", "info", "warn", "error"):
        raise ValueError(f"no such level: {level}")
    line = json.dumps({"at": datetime.now(UTC).isoformat(), "level": level, "event": event, "data": data}, ensure_ascii=False, allow_nan=False)
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "a", encoding="utf-8") as f:
        f.write(line + "\n")


def append_rows(rows: DataFrame, path: str) -> None:
    """Rows as more JSON Lines of a table."""
    rows.write.mode("append").json(path)


def write_part(rows: DataFrame, folder: str, part: int) -> None:
    """Rows as one part of a table; an error if the part exists or has no rows.

    Spark's commit protocol makes the part appear as a whole.
    """
    if part < 0:
        raise ValueError("parts are counted from 0")
    if rows.isEmpty():
        raise ValueError("a part has rows")
    rows.write.mode("errorifexists").json(f"{folder}/part={part}")


def write_once(rows: DataFrame, path: str, problems: DataFrame | None = None) -> None:
    """A table that must not exist yet, written only if a check found no problems."""
    if problems is not None and not problems.isEmpty():
        raise ValueError("the check found problems, so nothing is written")
    rows.write.mode("errorifexists").parquet(path)


def record(rows: DataFrame, path: str, key: str, problems: DataFrame | None = None) -> int:
    """Append rows to a Parquet table after all checks, or append none: an error if a key comes twice, is there already, or a check found problems."""
    spark = rows.sparkSession
    if not rows.groupBy(key).count().where("count > 1").isEmpty():
        raise ValueError("a key comes twice")
    fs, there = file_system(spark, path)
    if fs.exists(there) and not rows.join(spark.read.parquet(path).select(key), key, "left_semi").isEmpty():
        raise ValueError("a key is recorded already")
    if problems is not None and not problems.isEmpty():
        raise ValueError("the check found problems, so nothing is written")
    n = rows.count()
    rows.write.mode("append").parquet(path)
    return n


def write_summary(rows: DataFrame, path: str) -> dict:
    """The single row of an aggregate as a JSON document."""
    found = rows.select(F.to_json(F.struct("*")).alias("j")).limit(2).collect()
    if len(found) != 1:
        raise ValueError("a summary is one row")
    value = json.loads(found[0]["j"])
    write_json(path, value)
    return value


def write_schema(rows: DataFrame, path: str, rules: Sequence[tuple[str, Column]] = ()) -> None:
    """The schema of a table as a JSON document, with the rules of its contract."""
    write_json(path, json.loads(rows.schema.json()) | {"rules": [{"code": code, "holds": str(rule)} for code, rule in rules]})
