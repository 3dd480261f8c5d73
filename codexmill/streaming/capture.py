"""Incremental capture: pages behind a cursor, recovery from what is written, streams that end when all is read.

Folders may lie on any file system that Spark can reach; locks and notes are
files of it, so that a capture may be taken up on another machine.
"""

from __future__ import annotations

import json
import os
import socket
import time as clock
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from codexmill.operators.paging import after, cursors, gaps, page, page_size, parts
from codexmill.session import file_system

LEASE = 6 * 3600  # seconds after which a lock of another machine counts as left behind


def _read(spark: SparkSession, name: str) -> str | None:
    fs, path = file_system(spark, name)
    if not fs.exists(path):
        return None
    size = fs.getFileStatus(path).getLen()
    stream = fs.open(path)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, size)).decode()
    finally:
        stream.close()


def _write(spark: SparkSession, name: str, text: str, new: bool = False) -> None:
    """A file with a text; where it has to be ``new``, an error if it is there already."""
    fs, path = file_system(spark, name)
    stream = fs.create(path, not new)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _left_behind(owner: str, age: float) -> bool:
    host, _, process = owner.partition(" ")
    if host == socket.gethostname() and process.isdigit():
        return not Path(f"/proc/{process}").exists()
    return age > LEASE


@contextmanager
def locked(spark: SparkSession, name: str):
    """An exclusive lock file; one whose owner no longer runs is taken over.

    A lock is taken over by renaming it, which only one of several can do, so
    that no fresh lock of another is removed.
    """
    fs, path = file_system(spark, name)
    own = f"{socket.gethostname()} {os.getpid()}"
    while True:
        try:
            _write(spark, name, own, new=True)
            break
        except Exception as e:
            if not fs.exists(path):
                if "AlreadyExists" not in str(e):
                    raise
                continue
            owner, age = _read(spark, name) or "", clock.time() - fs.getFileStatus(path).getModificationTime() / 1000
            if not _left_behind(owner, age):
                raise RuntimeError(f"{owner or 'another process'} holds {name}") from None
            aside = f"{name}.{uuid.uuid4().hex}"
            if fs.rename(path, file_system(spark, aside)[1]):
                fs.delete(file_system(spark, aside)[1], False)
    try:
        yield
    finally:
        fs.delete(path, False)


def _parts(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the parts that are written whole."""
    fs, path = file_system(spark, folder)
    if not fs.exists(path):
        return []
    names = [s.getPath() for s in fs.listStatus(path)]
    return sorted(int(n.getName()[5:]) for n in names if n.getName().startswith("part=") and fs.exists(file_system(spark, f"{folder}/{n.getName()}/_SUCCESS")[1]))


def checkpoint(spark: SparkSession, folder: str, time: str, ident: str) -> dict | None:
    """Where a capture stands, worked out from its parts alone; None before the first.

    A crash between writing a part and noting it loses nothing, as nothing but
    the parts is trusted. Parts that don't follow each other are an error.
    """
    if not _parts(spark, folder):
        return None
    rows = spark.read.parquet(folder)
    if not gaps(rows, "part").isEmpty():
        raise ValueError("parts are missing")
    each = cursors(rows, "part", time, ident)
    last = each.orderBy(F.desc("part")).first()
    return {"next": int(last["part"]) + 1, "rows": each.agg(F.sum("n")).first()[0], "cursor": (last["last_time"], last["last_id"]), "last": last["n"]}


def noted(spark: SparkSession, folder: str, time: str, ident: str) -> dict | None:
    """Where a capture stands by its note, if the note tells of every part there is; otherwise worked out from the parts.

    So a page reads no part but, after a crash between a part and its note, all.
    """
    text = _read(spark, f"{folder}.state.json")
    note = json.loads(text) if text else None
    there = _parts(spark, folder)
    if note and there == list(range(note["next"])) and there:
        last = spark.read.parquet(f"{folder}/part={there[-1]}").orderBy(F.desc(time), F.desc(ident)).select(time, ident).first()
        return {"next": note["next"], "rows": note["total"], "cursor": (last[0], last[1]), "last": note["rows"]}
    return checkpoint(spark, folder, time, ident)


def capture_page(rows: DataFrame, folder: str, time: str, ident: str, n: int, start: tuple | None = None, cutoff: object = None) -> dict:
    """Write the next page as a part; ``complete`` once a page isn't full.

    ``start`` is another run's cursor to go on from. ``cutoff`` bounds the
    population and is the same for all pages of a capture; another one is an
    error.
    """
    spark = rows.sparkSession
    with locked(spark, f"{folder}.lock"):
        text = _read(spark, f"{folder}.state.json")
        if text and json.loads(text)["cutoff"] != (None if cutoff is None else str(cutoff)):
            raise ValueError("a capture has one cutoff")
        at = noted(spark, folder, time, ident)
        if at and at["last"] < n:
            return {"part": at["next"] - 1, "rows": 0, "complete": True}
        got = page(rows, time, ident, n, at["cursor"] if at else start, cutoff)
        number = at["next"] if at else 0
        path = f"{folder}/part={number}"
        # what an attempt that didn't end has left there is no part
        fs, left = file_system(spark, path)
        fs.delete(left, True)
        got.coalesce(1).write.mode("errorifexists").parquet(path)
        size = spark.read.schema(rows.schema).parquet(path).count()
        if not size:
            fs.delete(left, True)
        state = {"part": number, "next": number + bool(size), "rows": size, "total": (at["rows"] if at else 0) + size, "complete": size < n, "cutoff": None if cutoff is None else str(cutoff)}
        _write(spark, f"{folder}.state.json", json.dumps(state))
        return state


def successor_start(spark: SparkSession, folder: str, time: str, ident: str, cutoff: object) -> tuple:
    """The cursor from which another run goes on after this capture; an error if it is not complete or had another cutoff."""
    state = json.loads(_read(spark, f"{folder}.state.json") or "null")
    if not state or not state["complete"]:
        raise ValueError("the run before isn't complete")
    if state["cutoff"] != (None if cutoff is None else str(cutoff)):
        raise ValueError("a run goes on with the cutoff of the one before")
    return checkpoint(spark, folder, time, ident)["cursor"]


def capture_all(rows: DataFrame, folder: str, time: str, ident: str, n: int, cutoff: object = None) -> DataFrame:
    """Capture pages until none is left; the same rows as one batch would give, with their part.

    All pages that are left are numbered and written by one pass over the rows,
    beside the folder; then each is moved into it, in order and as a whole. So
    an end at any place leaves parts that follow each other, as page by page,
    and the same parts and note remain.
    """
    spark = rows.sparkSession
    with locked(spark, f"{folder}.lock"):
        text = _read(spark, f"{folder}.state.json")
        bound = None if cutoff is None else str(cutoff)
        if text and json.loads(text)["cutoff"] != bound:
            raise ValueError("a capture has one cutoff")
        at = noted(spark, folder, time, ident)
        if not at or at["last"] >= n:
            _capture_rest(rows, folder, time, ident, page_size(n), at, cutoff, bool(text))
    schema = StructType([*rows.schema.fields]).add("part", "long")
    return spark.read.schema(schema).parquet(folder) if _parts(spark, folder) else spark.createDataFrame([], schema)


def _capture_rest(rows: DataFrame, folder: str, time: str, ident: str, n: int, at: dict | None, cutoff: object, has_note: bool) -> None:
    """Write what is behind a checkpoint as parts of ``n`` rows and note the end."""
    spark, start = rows.sparkSession, at["next"] if at else 0
    bound = None if cutoff is None else str(cutoff)
    within = F.lit(True) if cutoff is None else F.col(time) <= F.lit(cutoff)
    left = rows.where(within & after(time, ident, at["cursor"] if at else None))
    numbered = parts(left, [time, ident], n).withColumn("part", F.col("part") + start)
    aside = f"{folder}.pages"
    fs, pages = file_system(spark, aside)
    fs.delete(pages, True)
    # each part is one file; tasks are so many that none writes all of them
    numbered.repartition(2 * spark.sparkContext.defaultParallelism, "part").sortWithinPartitions("part", time, ident).write.partitionBy("part").parquet(aside)
    numbers = sorted(int(s.getPath().getName()[5:]) for s in fs.listStatus(pages) if s.getPath().getName().startswith("part="))
    last = spark.read.schema(rows.schema).parquet(f"{aside}/part={numbers[-1]}").count() if numbers else 0
    if not has_note:
        # the cutoff holds from the first part on
        _write(spark, f"{folder}.state.json", json.dumps({"part": start - 1, "next": start, "rows": at["last"] if at else 0, "total": at["rows"] if at else 0, "complete": False, "cutoff": bound}))
    if numbers:
        fs.mkdirs(file_system(spark, folder)[1])
    for number in numbers:
        fs.create(file_system(spark, f"{aside}/part={number}/_SUCCESS")[1], True).close()
        # what an attempt that didn't end has left there is no part
        here = file_system(spark, f"{folder}/part={number}")[1]
        fs.delete(here, True)
        if not fs.rename(file_system(spark, f"{aside}/part={number}")[1], here):
            raise RuntimeError(f"part {number} can't be moved into {folder}")
    fs.delete(pages, True)
    # the page after the last full one is the last, whether it has rows or not
    rest, full = last % n, start + len(numbers) - bool(last % n)
    total = (at["rows"] if at else 0) + (len(numbers) - 1) * n * bool(numbers) + last
    _write(spark, f"{folder}.state.json", json.dumps({"part": full, "next": full + bool(rest), "rows": rest, "total": total, "complete": True, "cutoff": bound}))


def stream_files(spark: SparkSession, folder: str, schema: StructType, out: str, checkpoints: str, change: Callable[[DataFrame], DataFrame] = lambda d: d) -> int:
    """Take every new file of a folder exactly once and append what ``change`` makes of it; ends when all is read."""
    stream = change(spark.readStream.schema(schema).parquet(folder))
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoints).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def stream_counts(spark: SparkSession, folder: str, schema: StructType, key: str, time: str, late: str, window: str, out: str, checkpoints: str) -> None:
    """Counts by key and window of event time, for windows that no row can still be late for."""
    rows = spark.readStream.schema(schema).parquet(folder).withWatermark(time, late)
    counted = rows.groupBy(F.window(time, window), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")
    query = counted.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoints).trigger(availableNow=True).start()
    query.awaitTermination()


def pending(parts: DataFrame, done: DataFrame, part: str = "part", source: str = "source") -> DataFrame:
    """The sources of the first part that isn't done."""
    left = parts.join(done.select(part, source), [part, source], "left_anti")
    return left.join(F.broadcast(left.agg(F.min(part).alias(part))), part)  # one row


def progress(parts: DataFrame, done: DataFrame, part: str = "part", source: str = "source") -> DataFrame:
    """(completed, next, pending): one row with the last part that is complete together with all before it (-1 for none), the part to go on with and its sources left.

    Where every part is complete the next is null and nothing is pending.
    """
    each = _by_part(parts, done, part, source)
    open_ = F.when(F.col("done") < F.col("n"), F.struct(F.col(part).alias("p"), (F.col("n") - F.col("done")).alias("left")))
    one = each.agg(F.min(open_).alias("x"), F.max(part).alias("last"))
    return one.select(F.coalesce(F.col("x.p") - 1, "last", F.lit(-1)).cast("long").alias("completed"), F.col("x.p").cast("long").alias("next"), F.coalesce("x.left", F.lit(0)).cast("long").alias("pending"))


def _by_part(parts: DataFrame, done: DataFrame, part: str, source: str) -> DataFrame:
    marked = parts.select(part, source).distinct().join(done.select(source).distinct().withColumn("__done", F.lit(1)), source, "left")
    return marked.groupBy(part).agg(F.count("*").alias("n"), F.count("__done").alias("done"))


def next_batch(parts: DataFrame, done: DataFrame, n: int, part: str = "part", source: str = "source") -> DataFrame:
    """(part, source): up to ``n`` sources of the first part that isn't complete, in order of id; a batch never crosses a part."""
    left = parts.select(part, source).distinct().join(done.select(source), source, "left_anti")
    return left.join(F.broadcast(left.agg(F.min(part).alias(part))), part).orderBy(source).limit(n).select(part, source)  # one row


def status(parts: DataFrame, done: DataFrame, source: str = "source") -> DataFrame:
    """(sources, decisions, remaining, complete): one row."""
    both = parts.select(F.col(source).alias("s"), F.lit(True).alias("asked")).unionByName(done.select(F.col(source).alias("s"), F.lit(False).alias("asked")))
    one = both.agg(F.countDistinct(F.when(F.col("asked"), F.col("s"))).alias("sources"), F.countDistinct(F.when(~F.col("asked"), F.col("s"))).alias("decisions"))
    remaining = F.greatest(F.lit(0), F.col("sources") - F.col("decisions"))
    return one.select("sources", "decisions", remaining.alias("remaining"), (remaining == 0).alias("complete"))


def read_state(spark: SparkSession, folder: str) -> dict | None:
    """What the last capture noted, for a quick look; ``checkpoint`` is what counts."""
    text = _read(spark, f"{folder}.state.json")
    return json.loads(text) if text else None
