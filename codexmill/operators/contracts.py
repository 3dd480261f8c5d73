"""Contracts of records: what a record has to be, as the codes of the rules it breaks, and whether it agrees with what it was made from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexmill.operators.gates import violations

UUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
SHA256 = r"^[0-9a-f]{64}$"


def one_of(c: str, values: Sequence[object]) -> Column:
    return F.col(c).isin(*values)


def shaped(c: str, pattern: str) -> Column:
    return F.col(c).rlike(pattern)


def sized(c: str, least: int, most: int) -> Column:
    """Whether a text has so many characters."""
    return F.length(c).between(least, most)


def counted(c: str, least: int, most: int) -> Column:
    """Whether an array has so many members."""
    return F.size(c).between(least, most)


def optional(c: str, rule: Column) -> Column:
    """A rule for a field that may be null."""
    return F.col(c).isNull() | rule


def unknown_keys(json: str, known: Sequence[str]) -> Column:
    """The keys of a JSON object that a contract doesn't name, in order; null where the text is no object."""
    return F.array_sort(F.array_except(F.json_object_keys(json), F.array(*[F.lit(k) for k in known])))


def checked(rows: DataFrame, rules: Sequence[tuple[str, Column]], name: str = "violations") -> DataFrame:
    """Rows with the codes of the rules they break, in the order of the rules; an empty array where a record is sound."""
    return rows.withColumn(name, violations(rules))


def strict(rows: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """The same rows; an error that names the first broken rule where a record breaks one."""
    first = F.try_element_at(violations(rules), F.lit(1))
    return rows.where(F.assert_true(first.isNull(), F.concat(F.lit("a record breaks: "), first)).isNull())


def inconsistent(rows: DataFrame, key: str, recomputed: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """(key, field): stored values that differ from what they are worked out as anew, null being a value like others."""
    wrong = F.array_compact(F.array(*[F.when(~stored.eqNullSafe(anew), F.lit(name)) for name, (stored, anew) in recomputed.items()]))
    return rows.select(key, F.explode(wrong).alias("field"))


def bound(rows: DataFrame, known: DataFrame, ids: Mapping[str, Column], key: Sequence[str]) -> DataFrame:
    """(key, code, id): ids that rows name and that no known record has; ``ids`` gives an array of ids for each code.

    Every id is looked up once, however many rows name it.
    """
    named = F.array(*[F.struct(F.lit(code).alias("code"), F.array_distinct(F.array_compact(c)).alias("ids")) for code, c in ids.items()])
    each = rows.select(*key, F.explode(named).alias("x")).select(*key, "x.code", F.explode("x.ids").alias("id"))
    return each.join(known.select("id").distinct(), "id", "left_anti").select(*key, "code", "id")
