"""Keyset pages, global positions and parts, order checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codexmill.session import written


def page_size(n: object, most: int = 256) -> int:
    """A page size between 1 and ``most``; anything else is an error."""
    if isinstance(n, bool) or not isinstance(n, int) or not 1 <= n <= most:
        raise ValueError(f"a page size is a whole number from 1 to {most}, not {n!r}")
    return n


def after(time: str, ident: str, cursor: tuple[object, str] | None) -> Column:
    """Rows behind a cursor in the order (time, id); all rows for no cursor.

    Written out, so that the bound on the time reaches the scan.
    """
    if cursor is None:
        return F.lit(True)
    if len(cursor) != 2 or any(x is None for x in cursor):
        raise ValueError("a cursor is a time together with an id")
    t, i = F.lit(cursor[0]), F.lit(cursor[1])
    return (F.col(time) >= t) & ((F.col(time) > t) | (F.col(ident) > i))


def page(rows: DataFrame, time: str, ident: str, n: int, cursor: tuple[object, str] | None = None, cutoff: object = None) -> DataFrame:
    """The next ``n`` rows behind a cursor, none later than ``cutoff``; planned as a top-k, not as a sort of everything."""
    within = F.lit(True) if cutoff is None else F.col(time) <= F.lit(cutoff)
    return rows.where(within & after(time, ident, cursor)).orderBy(time, ident).limit(page_size(n))


def positions(rows: DataFrame, keys: Sequence[Column | str], name: str = "position") -> DataFrame:
    """Rows with their place (from 0) in the order of ``keys``, which must be a total order.

    Rows are parted by ranges of the keys and counted by part; a row's place is
    the number of rows in the parts before plus its place in its own. No task
    ever holds all rows, unlike with a window without partitions.
    """
    ranged = written(rows.repartitionByRange(*keys).withColumn("__part", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy("__part").agg(F.count("*").alias("__size"))
    # one row for each part, so the running sum is over a small table
    before = sizes.withColumn("__before", F.coalesce(F.sum("__size").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    own = F.row_number().over(Window.partitionBy("__part").orderBy(*keys)) - 1
    return ranged.withColumn("__own", own).join(F.broadcast(before.select("__part", "__before")), "__part").withColumn(name, F.col("__before") + F.col("__own")).drop("__part", "__own", "__before")


def parts(rows: DataFrame, keys: Sequence[str], n: int, name: str = "part") -> DataFrame:
    """Rows with the number of their part: every ``n`` rows in the order of ``keys``."""
    return positions(rows, keys, "__position").withColumn(name, F.floor(F.col("__position") / n)).drop("__position")


def cursors(rows: DataFrame, part: str, time: str, ident: str) -> DataFrame:
    """(part, n, time, id): the size of each part and its last row, which is the cursor of the next."""
    last = F.max(F.struct(F.col(time).alias("t"), F.col(ident).alias("i")))
    return rows.groupBy(part).agg(F.count("*").alias("n"), last.alias("x")).select(part, "n", F.col("x.t").alias("last_time"), F.col("x.i").alias("last_id"))


def disorder(rows: DataFrame, group: Sequence[str], order: Sequence[Column], value: Column) -> DataFrame:
    """Rows whose value isn't greater than that of the row before them in their group."""
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn("__value", value).withColumn("__before", F.lag("__value").over(w)).where(F.col("__value") <= F.col("__before")).drop("__value", "__before")


def gaps(numbers: DataFrame, part: str, group: Sequence[str] = ()) -> DataFrame:
    """(group, part, expected): part numbers of each group that don't follow the one before them, counted from 0."""
    each = numbers.select(*group, F.col(part).cast("long").alias(part)).distinct()
    w = Window.partitionBy(*group).orderBy(part)  # one row for each part
    return each.withColumn("expected", F.coalesce(F.lag(part).over(w) + 1, F.lit(0).cast("long"))).where(F.col(part) != F.col("expected"))


def batches(rows: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, name: str = "batch") -> DataFrame:
    """Rows with a batch number: every ``n`` rows of a group, so that no batch crosses a group."""
    return rows.withColumn(name, F.floor((F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1) / n))
