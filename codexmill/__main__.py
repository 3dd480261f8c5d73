"""Command line: ``python -m codexmill doctor|inventory|probe|init|next|status|audit FOLDER ...``; every answer is JSON on one line."""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

TABLES = {
    "book_evidence": ["id", "createdAt", "updatedAt", "localizationLanguages"],
    "localizations": ["locId", "unitId", "language", "title"],
    "aliases": ["unitId", "term"],
    "attributions": ["unitId", "creditedUnitId"],
    "decisions": ["runId", "part", "sourceUnitId", "disposition"],
}


def init(run: str, folder: str, page: int, cutoff: str | None) -> dict:
    """Lay out a run; an error if it is there already or its settings are none."""
    from codexmill.operators.paging import page_size
    from codexmill.sources.sinks import append_event, write_json

    config = {"folder": folder, "page": page_size(page), "cutoff": cutoff}
    root = Path(run)
    root.mkdir(parents=True)
    write_json(str(root / "run.json"), config)
    append_event(str(root / "events.jsonl"), "run.initialised", **config)
    return config


def settings(run: str) -> dict:
    from codexmill.sources.files import json_document

    return json_document(str(Path(run) / "run.json"), ["folder", "page", "cutoff"])


def rows_of(df: DataFrame) -> list[dict]:
    return [json.loads(r) for r in df.toJSON().collect()]


def answer(spark: SparkSession, a: argparse.Namespace) -> object:
    from pyspark.sql import functions as F

    from codexmill import queries
    from codexmill.plans.profile import doctor, probe
    from codexmill.session import shared_dir
    from codexmill.sources.sinks import append_event
    from codexmill.streaming.capture import capture_page, read_state

    if a.command == "doctor":
        return {"problems": doctor(spark, TABLES, a.folder), "shared": shared_dir(spark)}
    if a.command == "init":
        return init(a.run, a.folder, a.page, a.cutoff)
    if a.command == "probe":
        return probe(queries.queries()[a.query](spark, a.folder))
    if a.command == "inventory":
        return {"summary": rows_of(queries.inventory_summary(spark, a.folder)), "languageSets": rows_of(queries.inventory_language_sets(spark, a.folder))}
    if a.command == "audit":
        return rows_of(queries.audit_report(spark, a.folder))
    config = settings(a.run)
    parts = str(Path(a.run) / "parts")
    if a.command == "status":
        return {"capture": read_state(spark, parts), "decisions": rows_of(queries.run_status(spark, config["folder"]))}
    cutoff = None if config["cutoff"] is None else F.lit(config["cutoff"]).cast("timestamp")
    state = capture_page(queries.chinese(spark, config["folder"]), parts, "created", "id", config["page"], cutoff=cutoff)
    append_event(str(Path(a.run) / "events.jsonl"), "page.captured", **state)
    return state


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="codexmill")
    commands = p.add_subparsers(dest="command", required=True)
    for name in ("doctor", "inventory", "audit"):
        commands.add_parser(name).add_argument("folder")
    c = commands.add_parser("probe")
    c.add_argument("folder")
    c.add_argument("query")
    c = commands.add_parser("init")
    c.add_argument("run")
    c.add_argument("folder")
    c.add_argument("--page", type=int, default=64)
    c.add_argument("--cutoff")
    for name in ("next", "status"):
        commands.add_parser(name).add_argument("run")
    a = p.parse_args(argv)
    if spark is None:
        from codexmill.session import local_session

        spark = local_session("codexmill")
        spark.sparkContext.setLogLevel("ERROR")
    found = answer(spark, a)
    print(json.dumps(found, ensure_ascii=False, default=str))
    return int(bool(isinstance(found, dict) and found.get("problems")))


if __name__ == "__main__":
    raise SystemExit(main())
