"""Relational operators over a catalog: predicates on sets, joins with children, ordered aggregates, inventory."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def norm_id(c: Column | str) -> Column:
    """An id in lower case without outer white space."""
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))


def instant(c: str) -> Column:
    """An ISO time with any offset as an instant, null where it is none."""
    return F.expr(f"try_cast({c} as timestamp)")


def latest(rows: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """One row of each key: the last by ``order``. A row is a struct in one aggregate, so no sort is needed."""
    payload = F.struct(*[F.col(c) for c in rows.columns])
    return rows.groupBy(F.col(key).alias("__key")).agg(F.max_by(payload, F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).alias("__row")).select("__row.*")


def matching(required: Mapping[str, object]) -> Column:
    """Equality with each of some fixed values; a null value asks for null."""
    out = F.lit(True)
    for name, value in required.items():
        out = out & (F.col(name).isNull() if value is None else F.col(name) == F.lit(value))
    return out


def exact_set(parents: DataFrame, children: DataFrame, key: str, member: str, values: Sequence[str]) -> DataFrame:
    """Parents whose children's members are exactly ``values``: all of them, and no other.

    A semi join for each value and one anti join with the rest; a null member
    is no member.
    """
    for v in values:
        parents = parents.join(children.where(F.col(member) == v).select(key), key, "left_semi")
    return parents.join(children.where(F.col(member).isNotNull() & ~F.col(member).isin(*values)).select(key), key, "left_anti")


def exact_array(c: str, values: Sequence[str]) -> Column:
    """Whether an array holds exactly ``values``, in any order and number, nulls aside."""
    return F.coalesce(F.array_sort(F.array_distinct(F.array_compact(c))) == F.array(*[F.lit(v) for v in sorted(set(values))]), F.lit(False))


def sorted_set(c: Column | str) -> Column:
    """Aggregate: the distinct values in order, nulls aside; an empty array where there are none."""
    return F.array_sort(F.collect_set(c))


def ordered_list(keys: Sequence[Column], payload: Column) -> Column:
    """Aggregate: payloads in the order of ``keys``, then of the payload itself, so that ties don't depend on the order of rows."""
    entry = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)], payload.alias("payload"))
    return F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["payload"])


def descending_number(c: Column | str) -> Column:
    """A sort key for the reverse order of numbers; nulls stay null."""
    return -(F.col(c) if isinstance(c, str) else c)


def nulls_last(c: Column | str) -> tuple[Column, Column]:
    """Sort keys that put nulls last in an ascending array sort."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull(), c


def with_children(parents: DataFrame, key: str, children: Mapping[str, tuple[DataFrame, Sequence[Column], Column]], required: Sequence[str] = ()) -> DataFrame:
    """Parents with an array of each kind of child.

    Children are aggregated by key before the join, so kinds don't multiply
    each other. A parent without children gets an empty array, or null where the
    kind is ``required``, which a contract check then reports.
    """
    for name, (rows, order, payload) in children.items():
        lists = rows.groupBy(key).agg(ordered_list(order, payload).alias(name))
        parents = parents.join(lists, key, "left")
        if name not in required:
            parents = parents.withColumn(name, F.coalesce(name, F.array().cast(lists.schema[name].dataType)))
    return parents


def language_sets(parents: DataFrame, children: DataFrame, key: str, member: str, carried: Sequence[str] = ()) -> DataFrame:
    """(key, carried, members): the sorted set of members of each parent, empty where it has no child, with other fields of the parent."""
    sets = children.select(key, member).groupBy(key).agg(sorted_set(member).alias("members"))
    return parents.select(key, *carried).join(sets, key, "left").withColumn("members", F.coalesce("members", F.array().cast(sets.schema["members"].dataType)))


def set_distribution(sets: DataFrame, members: str = "members") -> DataFrame:
    """(members, n): how many parents have each set."""
    return sets.groupBy(members).agg(F.count("*").alias("n"))


def top_distribution(sets: DataFrame, members: str = "members") -> DataFrame:
    """The distribution, most frequent first, ties by the set."""
    return set_distribution(sets, members).orderBy(F.desc("n"), members)


def one_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, issue): keys that aren't assigned exactly once: 'missing', 'unexpected' or 'duplicate'.

    Both sides are counted by key first, so a key repeated any number of times
    crosses the join as one row.
    """
    a = left.groupBy(key).agg(F.count("*").alias("na"))
    b = right.groupBy(key).agg(F.count("*").alias("nb"))
    both = a.join(b, key, "full_outer")
    issue = F.when(F.col("nb").isNull(), "missing").when(F.col("na").isNull(), "unexpected").when(F.col("nb") > 1, "duplicate")
    return both.select(key, issue.alias("issue")).where("issue is not null")


def first_seen(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in an order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def top_each(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], most: int, rank: str = "rank") -> DataFrame:
    """The first ``most`` rows of each key with their rank; Spark keeps no more than that many before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= most)


def counters(rows: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """(dimension, value, n): counts by each of several columns, in one pass."""
    pairs = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions])).alias("x")
    return rows.select(pairs).select("x.*").groupBy("dimension", "value").agg(F.count("*").alias("n"))
