"""Canonical JSON and ids derived from content."""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical_json(value: object) -> str:
    """JSON with sorted keys and without blanks; whole floats are written as integers, as a number has one spelling."""

    def plain(x: object) -> object:
        if isinstance(x, Mapping):
            return {str(k): plain(v) for k, v in x.items()}
        if isinstance(x, float):
            if not math.isfinite(x):
                raise ValueError("a number that is not finite has no JSON")
            return int(x) if x.is_integer() and abs(x) < 2**53 else x
        if isinstance(x, Sequence) and not isinstance(x, str):
            return [plain(v) for v in x]
        return x

    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def content_hash(value: object) -> str:
    return hashlib.sha256(canonical_json(value).encode()).hexdigest()


@F.pandas_udf(T.StringType())
def json_hash(documents: pd.Series) -> pd.Series:
    """The hash of JSON texts, whatever the order of their keys and their blanks; null of null and of what isn't JSON."""

    def one(text: str | None) -> str | None:
        try:
            return None if text is None else content_hash(json.loads(text))
        except ValueError:
            return None

    return documents.map(one)


def struct_hash(*columns: str) -> Column:
    """The hash of a record of columns, by its JSON with all fields, sorted; stays in the JVM for structs of strings and whole numbers."""
    fields = F.struct(*[F.col(c).alias(c) for c in sorted(columns)])
    return F.sha2(F.to_json(fields, {"ignoreNullFields": "false"}), 256)


def derived_id(*columns: Column | str, size: int = 32) -> Column:
    """An id of so many hex digits, the same for the same values."""
    return F.left(F.sha2(F.concat_ws("\x1f", *columns), 256), F.lit(size))
