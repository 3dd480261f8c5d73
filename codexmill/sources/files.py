"""Sources: relations, statements with named parameters, lists from JSON, JSON and JSON Lines files."""

from __future__ import annotations

import json
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from codexmill.functions.text import PART_FILE, part_number
from codexmill.operators.contracts import unknown_keys


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def relations(spark: SparkSession, folder: str, names: list[str]) -> None:
    """Register tables of a folder as views, for statements that name them."""
    for name in names:
        table(spark, folder, name).createOrReplaceTempView(name)


def statement(spark: SparkSession, path: str, **parameters: object) -> DataFrame:
    """The result of the SQL in a file with its ``:name`` parameters bound, never pasted into the text."""
    return spark.sql(Path(path).read_text(), args=parameters)


def jdbc(spark: SparkSession, options: dict[str, str], table: str | None = None, query: str | None = None) -> DataFrame:
    """A relation or a query of a database, from exactly one of both; ``options`` hold the url, driver and partitioning."""
    if (table is None) == (query is None):
        raise ValueError("name either a table or a query")
    if "url" not in options:
        raise ValueError("a database needs a url")
    return spark.read.format("jdbc").options(**options, **({"dbtable": table} if table else {"query": query})).load()


def id_list(spark: SparkSession, ids: str, name: str = "id") -> DataFrame:
    """The distinct ids of a JSON array of strings; an error where it isn't one."""
    rows = spark.range(1).select(F.from_json(F.lit(ids), "array<string>", {"mode": "FAILFAST"}).alias("x"))
    return rows.select(F.explode("x").alias(name)).where(F.col(name).isNotNull()).distinct()


def record_set(spark: SparkSession, records: str, fields: str) -> DataFrame:
    """The records of a JSON array of objects with the fields of a DDL string; fields that aren't given are null."""
    rows = spark.range(1).select(F.from_json(F.lit(records), f"array<struct<{fields}>>", {"mode": "FAILFAST"}).alias("x"))
    return rows.select(F.inline("x"))


def json_lines(spark: SparkSession, path: str, schema: StructType, strict: bool = True) -> DataFrame:
    """Records of JSON Lines, split at line feeds only; blank lines are skipped.

    A strict read ends with an error at the first line that doesn't fit; otherwise
    such a line is a row with ``_error`` holding it and every field null.
    ``bad_lines`` tells which lines those are.
    """
    lines = spark.read.option("lineSep", "\n").text(path).where(F.trim("value") != "")
    shaped = StructType([*schema.fields]).add("_error", "string")
    read = lines.select("value", F.from_json("value", shaped, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_error"}).alias("x"))
    if strict:
        good = F.assert_true(F.col("x._error").isNull(), F.concat(F.lit("this line doesn't fit the contract: "), F.left("value", F.lit(200))))
        return read.where(good.isNull()).select("x.*").drop("_error")
    return read.select("x.*")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value): lines with their numbers from 1, for messages that name the line.

    Each file is one row, so this is for control files and not for data.
    """
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split("value", "\n")).alias("n", "value"))
    return whole.where(F.trim("value") != "").select("file", (F.col("n") + 1).alias("line"), "value")


def bad_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """(file, line, problem, value): the lines of JSON Lines that don't fit a schema or have keys that it doesn't name."""
    shaped = StructType([*schema.fields]).add("_error", "string")
    read = numbered_lines(spark, path).select("*", F.from_json("value", shaped, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_error"}).alias("x"))
    keys = unknown_keys("value", schema.fieldNames())
    problem = F.when(F.col("x._error").isNotNull() | F.json_object_keys("value").isNull(), "doesn't fit").when(F.size(keys) > 0, F.concat(F.lit("unknown keys: "), F.array_join(keys, ", ")))
    return read.select("file", "line", problem.alias("problem"), "value").where("problem is not null")


def checked_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Records of JSON Lines that all fit; an error that names the first line that doesn't."""
    bad = bad_lines(spark, path, schema).orderBy("file", "line").first()
    if bad:
        raise ValueError(f"{bad['file']}, line {bad['line']}: {bad['problem']}")
    return json_lines(spark, path, schema)


def json_document(path: str, known: Sequence[str] | None = None) -> object:
    """A JSON file of the control plane; an error where it is an object with keys that aren't ``known``."""
    value = json.loads(Path(path).read_text())
    if known is not None and (not isinstance(value, dict) or set(value) - set(known)):
        raise ValueError(f"{path} has to be an object with no keys but {', '.join(known)}")
    return value


def decision_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Records of a file that is a JSON array, one JSON object, or JSON Lines; only its first lines are looked at to tell."""
    head = [r["value"].strip() for r in spark.read.option("lineSep", "\n").text(path).where(F.trim("value") != "").limit(2).collect()]
    if head and head[0][0] not in "[{":
        raise ValueError("decisions are objects")
    if len(head) == 2 and head[0][0] == "{":
        try:
            json.loads(head[0])
            return json_lines(spark, path, schema)
        except ValueError:
            pass
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path, multiLine=True)


def part_files(folder: str) -> list[tuple[int, str]]:
    """(number, path) of the part files in a folder in the order of their numbers, whatever their width."""
    found = [(int(m.group(1)), str(p)) for p in Path(folder).iterdir() if (m := PART_FILE.search(p.name))]
    return sorted(found)


def with_part(rows: DataFrame, name: str = "part") -> DataFrame:
    """Rows of part files with the number of the file they came from."""
    return rows.withColumn(name, part_number(F.input_file_name()))


def inside(root: str, path: str) -> Path:
    """A path resolved, which has to lie in a folder; an error otherwise."""
    full = Path(root, path).resolve()
    if not full.is_relative_to(Path(root).resolve()):
        raise ValueError(f"{path} leaves {root}")
    return full
