"""A pluggable worker over batches of records: only what it rejects is tried again, and failures stay as rows."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, StringType, StructType


class Rejected(Exception):
    """One item's result isn't acceptable; the message is passed on as feedback with the next attempt."""


class Fatal(Exception):
    """The worker can't go on with this batch, and trying again won't help."""


class Limited(Exception):
    """The worker asks for a pause."""


# items, feedback by id -> for each id its result, or the exception that rejects it
Worker = Callable[[Sequence[Mapping], Mapping[str, str]], Mapping[str, object]]


def backoff(attempt: int, limited: bool) -> float:
    """Seconds before an attempt after so many: 5 each where the worker is limited, else doubling from a quarter up to 2."""
    return 5.0 * attempt if limited else min(2.0, 0.25 * 2 ** (attempt - 1))


def settled(items: Sequence[Mapping], ident: str, worker: Worker, attempts: int, pause: Callable[[float], None]) -> Iterator[tuple[str, int, Mapping | None, str | None]]:
    """(id, attempts, result, error) of each item of one batch, in any order."""
    left, feedback = {str(i[ident]): i for i in items}, {}
    for attempt in range(1, attempts + 1):
        limited = False
        try:
            made = worker(list(left.values()), {k: v for k, v in feedback.items() if k in left})
        except Fatal as e:
            yield from ((k, attempt, None, f"fatal: {e}") for k in left)
            return
        except Exception as e:  # noqa: BLE001 - whatever a worker raises is a failure of this attempt
            made, limited = {}, isinstance(e, Limited)
            feedback |= dict.fromkeys(left, str(e))
        for k in list(left):
            result = made.get(k, Rejected(feedback.get(k, "no result")))
            if isinstance(result, Exception):
                feedback[k] = str(result)
            else:
                yield k, attempt, result, None
                del left[k]
        if not left:
            return
        if attempt < attempts:
            pause(backoff(attempt, limited))
    yield from ((k, attempts, None, f"rejected: {feedback[k]}") for k in left)


def decided(rows: DataFrame, worker: Worker, schema: StructType, ident: str = "id", batch: int = 5, attempts: int = 3, pause: Callable[[float], None] = time.sleep) -> DataFrame:
    """(id, attempts, error, fields of ``schema``): what a worker makes of each row.

    ``worker`` is any picklable callable; it gets up to ``batch`` items at a
    time, as mappings, with the feedback on what it was refused before. A batch
    never holds rows of two partitions. An item that is rejected ``attempts``
    times, or met by a fatal error, is a row with its error and null fields, so
    that one item ends no other's work. Ids are unique and not null.
    """
    if batch < 1 or attempts < 1:
        raise ValueError("a batch has an item and an item an attempt")
    names = [f.name for f in schema.fields]
    out = StructType().add(ident, StringType()).add("attempts", IntegerType()).add("error", StringType())
    for f in schema.fields:
        out = out.add(f.name, f.dataType, True)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            items = frame.to_dict("records")
            made = [x for i in range(0, len(items), batch) for x in settled(items[i : i + batch], ident, worker, attempts, pause)]
            yield pd.DataFrame([(k, n, error, *((result or {}).get(c) for c in names)) for k, n, result, error in made], columns=[ident, "attempts", "error", *names])

    return rows.mapInPandas(run, out)
