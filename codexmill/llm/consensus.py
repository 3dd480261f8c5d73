"""Problem 3: the best representative of each duplicate group.

Every value is a sequence of tokens. The values of a group are aligned
progressively, the tokens of each column vote by weight, and the existing value
that is closest to the winning sequence is the group's representative.

A group may hold any number of rows, so it is never put into one task:

1. equal values are counted together before anything else;
2. values are aligned in chunks of ``CHUNK``, whose consensus sequences are
   aligned in chunks again until one backbone is left for the group;
3. each value is aligned to the backbone by itself and votes there, so that the
   votes of all rows are summed by an ordinary distributed aggregate;
4. the distance of each value to the winners is taken where the value lies.

A token may carry a merit. Votes are compared by merit first and by summed
weight then, so a token that is better evidence can't be outvoted by many worse.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codexmill.session import written

CHUNK = 64
GAP = -1.0


def likeness(a: str, b: str) -> float:
    """2 for equal tokens, 1 for tokens of one kind (the part before a colon), else -1."""
    if a == b:
        return 2.0
    ka, colon, _ = a.partition(":")
    return 1.0 if colon and ka == b.partition(":")[0] else -1.0


def trace(left: list[str], right: list[str]) -> list[tuple[int | None, int | None]]:
    """Global alignment of two token sequences as pairs of places, ``None`` for a gap."""
    if left == right:
        return [(i, i) for i in range(len(left))]
    n, m = len(left), len(right)
    score = np.zeros((n + 1, m + 1))
    score[:, 0] = GAP * np.arange(n + 1)
    score[0, :] = GAP * np.arange(m + 1)
    like = [[likeness(a, b) for b in right] for a in left]
    for i in range(1, n + 1):
        above, here, row = score[i - 1].tolist(), score[i].tolist(), like[i - 1]
        for j in range(1, m + 1):
            here[j] = max(above[j - 1] + row[j - 1], above[j] + GAP, here[j - 1] + GAP)
        score[i] = here
    out, i, j = [], n, m
    while i or j:
        if i and j and score[i, j] == score[i - 1, j - 1] + like[i - 1][j - 1]:
            i, j = i - 1, j - 1
            out.append((i, j))
        elif i and score[i, j] == score[i - 1, j] + GAP:
            i -= 1
            out.append((i, None))
        else:
            j -= 1
            out.append((None, j))
    return out[::-1]


def distance(left: list[str], right: list[str]) -> int:
    """Columns of the alignment in which two sequences differ."""
    return sum(i is None or j is None or left[i] != right[j] for i, j in trace(left, right))


def progressive(values: list[tuple[list[str], list[float], float]]) -> tuple[list[str], list[float], float]:
    """The consensus of a chunk: values join a growing profile, heaviest first, then columns vote."""
    values = sorted(values, key=lambda v: (-v[2], v[0]))
    columns: list[dict[str, list[float]]] = []
    seen = 0.0
    lead: list[str] = []
    for tokens, merits, weight in values:
        grown: list[dict[str, list[float]]] = []
        for i, j in trace(lead, tokens):
            votes = columns[i] if i is not None else {"": [float("-inf"), seen]}
            name, merit = (tokens[j], merits[j]) if j is not None else ("", float("-inf"))
            old = votes.get(name, [float("-inf"), 0.0])
            votes[name] = [max(old[0], merit), old[1] + weight]
            grown.append(votes)
        columns, seen = grown, seen + weight
        lead = [max((t for t in c if t), key=lambda t, c=c: (c[t], t)) for c in columns]
    won = [max(c, key=lambda t, c=c: (c[t], t)) for c in columns]
    return [t for t in won if t], [c[t][0] for c, t in zip(columns, won, strict=True) if t], seen


_VALUE = T.StructType([T.StructField("tokens", T.ArrayType(T.StringType())), T.StructField("merits", T.ArrayType(T.DoubleType())), T.StructField("weight", T.DoubleType())])

_VOTES = T.ArrayType(T.StructType([T.StructField("at", T.DoubleType()), T.StructField("token", T.StringType()), T.StructField("merit", T.DoubleType())]))


@F.pandas_udf(_VALUE)
def _chunk_consensus(values: pd.Series) -> pd.DataFrame:
    rows = [progressive([(list(v["tokens"]), list(v["merits"]), v["weight"]) for v in vs]) for vs in values]
    return pd.DataFrame({"tokens": [r[0] for r in rows], "merits": [r[1] for r in rows], "weight": [r[2] for r in rows]})


@F.pandas_udf(_VOTES)
def _votes(backbone: pd.Series, tokens: pd.Series, merits: pd.Series) -> pd.Series:
    """Where each token of a value votes; an inserted token votes between two columns of the backbone."""
    out = []
    for lead, own, marks in zip(backbone, tokens, merits, strict=True):
        at, extra, votes = -1, 0, []
        for i, j in trace(list(lead), list(own)):
            if i is not None:
                at, extra = i, 0
                votes.append((float(i), own[j] if j is not None else "", float(marks[j]) if j is not None else float("-inf")))
            else:
                extra += 1
                votes.append((at + extra / (extra + 1), own[j], float(marks[j])))
        out.append([{"at": a, "token": t, "merit": m} for a, t, m in votes])
    return pd.Series(out)


@F.pandas_udf(T.IntegerType())
def _distance(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series([distance(list(a), list(b)) for a, b in zip(left, right, strict=True)])


def consensus(values: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(group, unit, tokens, consensus, distance) for rows (group, unit, tokens, merits, weight).

    ``tokens`` is a non-null array of strings, ``merits`` an array of as many
    doubles, ``weight`` a positive double. Rows with a null group, unit or
    tokens have no place in a group and are left out. Repeated rows count once.
    Distance 0 means that a value is the consensus. Ties between tokens go to
    the greater token, so the result doesn't depend on the order of rows.
    """
    rows = written(values.select("group", "unit", "tokens", "merits", F.col("weight").cast("double").alias("weight")).where("group is not null and unit is not null and tokens is not null").dropDuplicates(["group", "unit", "tokens"]), "values")
    distinct = rows.groupBy("group", "tokens", "merits").agg(F.sum("weight").alias("weight"))
    level = distinct
    while True:
        sizes = level.groupBy("group").agg(F.count("*").alias("n"))
        most = sizes.agg(F.max("n")).first()[0] or 0
        parted = level.join(sizes, "group").withColumn("chunk", F.pmod(F.xxhash64("tokens"), F.ceil(F.col("n") / chunk)).cast("int"))
        level = (
            parted.groupBy("group", "chunk")
            .agg(F.collect_list(F.struct("tokens", "merits", "weight")).alias("vs"))
            .select("group", _chunk_consensus("vs").alias("v"))
            .select("group", "v.tokens", "v.merits", "v.weight")
        )
        if most <= chunk:
            break
        level = written(level, "chunks")
    backbone = level.select("group", F.col("tokens").alias("lead"))
    votes = (
        distinct.join(backbone, "group")
        .select("group", "weight", F.explode(_votes("lead", "tokens", "merits")).alias("v"))
        .groupBy("group", "v.at", "v.token")
        .agg(F.max("v.merit").alias("merit"), F.sum("weight").alias("votes"))
    )
    total = distinct.groupBy("group").agg(F.sum("weight").alias("total"))
    won = votes.groupBy("group", "at").agg(F.max_by("token", F.struct("merit", "votes", "token")).alias("token"), F.sum("votes").alias("said"))
    final = (
        won.join(total, "group")
        .where("token <> '' and said * 2 > total")
        .groupBy("group")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "token"))), lambda x: x["token"]).alias("consensus"))
    )
    return rows.join(final, "group").withColumn("distance", _distance("tokens", "consensus")).select("group", "unit", "tokens", "consensus", "distance", "weight")


def usable_isbn(column: str) -> F.Column:
    """Whether a value is 13 digits with a right check digit and the prefix 978 or 979, blanks and hyphens aside."""
    bare = F.regexp_replace(column, r"[\s ‐-―\-]", "")
    digits = F.transform(F.sequence(F.lit(1), F.lit(13)), lambda i: F.substring(bare, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 3).otherwise(1))
    return F.coalesce(F.when(bare.rlike("^97[89][0-9]{10}$"), F.aggregate(digits, F.lit(0), lambda a, x: a + x) % 10 == 0), F.lit(False))


def norm_id(column: str) -> F.Column:
    return F.lower(F.regexp_replace(column, r"^\s+|\s+$", ""))


def instant(column: str) -> F.Column:
    return F.expr(f"try_cast({column} as timestamp)")


def book_merits(books: DataFrame, localizations: DataFrame) -> DataFrame:
    """(unit, isbn, pages, langs, made): the criteria of each book, from its row with the latest ``updatedAt``."""
    rows = books.select(norm_id("id").alias("unit"), F.struct(instant("updatedAt").alias("u"), F.col("capturedAt").alias("c")).alias("late"), F.struct(usable_isbn("details.isbn13").alias("isbn"), F.coalesce(F.col("details.pageCount") > 0, F.lit(False)).alias("pages"), instant("createdAt").alias("made")).alias("x")).where("unit <> ''")
    newest = rows.groupBy("unit").agg(F.max_by("x", "late").alias("x"))
    langs = localizations.where("language is not null and language <> ''").select(norm_id("unitId").alias("unit"), "language").groupBy("unit").agg(F.countDistinct("language").alias("langs"))
    return newest.join(langs, "unit", "left").select("unit", "x.isbn", "x.pages", "x.made", F.coalesce("langs", F.lit(0)).alias("langs"))


def survivors(groups: DataFrame, books: DataFrame, localizations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(groupId, unitId, distance, best): members of each group with two or more known books against the group's consensus.

    A member's value is the sequence of its four criteria, each a token whose
    merit is how good it is: usable isbn13, usable page count, number of
    languages, instant of creation.
    """
    found = groups.select(F.col("groupId").alias("group"), F.col("unitId").alias("unit")).join(book_merits(books, localizations), "unit")
    micros = F.coalesce(F.unix_micros("made"), F.lit(-(1 << 60)))
    values = found.select(
        "group",
        "unit",
        F.array(F.concat(F.lit("isbn:"), F.col("isbn").cast("string")), F.concat(F.lit("pages:"), F.col("pages").cast("string")), F.concat(F.lit("langs:"), F.lpad(F.col("langs").cast("string"), 6, "0")), F.concat(F.lit("made:"), micros.cast("string"))).alias("tokens"),
        F.array(F.col("isbn").cast("double"), F.col("pages").cast("double"), F.col("langs").cast("double"), micros.cast("double")).alias("merits"),
        F.lit(1.0).alias("weight"),
    )
    held = values.groupBy("group").count().where("count > 1").select("group")
    judged = consensus(values.join(held, "group", "left_semi"), chunk)
    best = judged.groupBy("group").agg(F.min_by("unit", F.struct("distance", "unit")).alias("best"))
    return judged.join(best, "group").select(F.col("group").alias("groupId"), F.col("unit").alias("unitId"), "distance", (F.col("unit") == F.col("best")).alias("best"))


def clear_survivors(groups: DataFrame, books: DataFrame, localizations: DataFrame) -> DataFrame:
    """(groupId, unitId) of members no worse than every other in all criteria and better than each in one.

    Such a member has the best token of every column, so its distance to the
    consensus is 0; it is better than each other where no other has distance 0.
    """
    judged = survivors(groups, books, localizations)
    return judged.where("distance = 0").groupBy("groupId").agg(F.count("*").alias("n"), F.min("unitId").alias("unitId")).where("n = 1").select("groupId", "unitId")


def trust(latest: F.Column) -> F.Column:
    """The weight of a book's votes: 1, and as much again each for a usable isbn13, for approval, and for how recent it is.

    The last falls by half with each year before ``latest``, the group's newest
    update; a book without an instant has none of it.
    """
    years = (F.unix_micros(latest) - F.unix_micros("updated")) / (365.25 * 86400e6)
    return F.lit(1.0) + usable_isbn("details.isbn13").cast("double") + F.coalesce((F.col("moderationStatus") == "approved").cast("double"), F.lit(0.0)) + F.coalesce(F.pow(F.lit(0.5), years), F.lit(0.0))


def surviving_values(groups: DataFrame, books: DataFrame, localizations: DataFrame | None = None, chunk: int = CHUNK) -> DataFrame:
    """(groupId, field, value, distance): for each group and field of a book, the existing value closest to the group's consensus.

    Values are sequences of tokens: the words of a title (its characters where it
    has ideographs), the parts of a date, one for what can't be parted. They vote
    with the trust in their book. Unusable values have no vote: an isbn13 with a
    wrong check digit, a page count that isn't positive, a blank text. Titles
    vote by language, as fields ``title:en`` and so on. Of values at one distance
    the one with more weight behind it wins, then the greater. A field without a
    usable value has no row. Of several rows of a book all usable values count,
    each once.
    """
    rows = books.select(
        norm_id("id").alias("unitId"),
        instant("updatedAt").alias("updated"),
        "details",
        "moderationStatus",
        F.when(usable_isbn("details.isbn13"), F.regexp_replace("details.isbn13", r"[^0-9]", "")).alias("isbn13"),
        F.when(F.col("details.pageCount") > 0, F.col("details.pageCount").cast("string")).alias("pageCount"),
        F.when(F.trim("details.publicationDate") != "", F.trim("details.publicationDate")).alias("publicationDate"),
        F.when(F.trim("details.releaseStatus") != "", F.trim("details.releaseStatus")).alias("releaseStatus"),
    )
    members = groups.select("groupId", "unitId").distinct()
    known = members.join(rows, "unitId")
    newest = known.groupBy("groupId").agg(F.max("updated").alias("latest"))
    weighed = known.join(newest, "groupId").withColumn("weight", trust(F.col("latest")))
    names = ("isbn13", "pageCount", "publicationDate", "releaseStatus")
    each = F.explode(F.create_map(*[x for n in names for x in (F.lit(n), F.col(n))])).alias("field", "value")
    values = weighed.select("groupId", "unitId", "weight", each)
    if localizations is not None:
        title = F.trim(F.regexp_replace("title", r"\s+", " ")).alias("value")
        titles = localizations.where("language <> ''").select(norm_id("unitId").alias("unitId"), F.concat(F.lit("title:"), F.lower("language")).alias("field"), title)
        trusted = weighed.groupBy("groupId", "unitId").agg(F.max("weight").alias("weight"))
        values = values.unionByName(trusted.join(titles, "unitId").select("groupId", "unitId", "weight", "field", "value"))
    values = values.where("value <> ''").groupBy("groupId", "field", "unitId", "value").agg(F.max("weight").alias("weight"))
    wide = F.col("value").rlike("[\u3040-\u30ff\u3400-\u9fff]")
    tokens = F.when(F.col("field") == "publicationDate", F.split("value", "-")).when(F.col("field").startswith("title:"), F.when(wide, F.split("value", "")).otherwise(F.split("value", " "))).otherwise(F.array("value"))
    typed = values.select(F.concat_ws("|", "groupId", "field").alias("group"), F.concat_ws("|", "unitId", "value").alias("unit"), F.array_remove(tokens, "").alias("tokens"), "weight")
    voted = typed.select("group", "unit", "tokens", F.transform("tokens", lambda t: F.lit(0.0)).alias("merits"), "weight")
    judged = consensus(voted, chunk)
    value = F.expr("substring(unit, locate('|', unit) + 1)").alias("value")
    per = judged.groupBy("group", "distance", value).agg(F.sum("weight").alias("weight"))
    best = per.groupBy("group").agg(F.max_by(F.struct("value", "distance"), F.struct(-F.col("distance"), F.round("weight", 6), F.col("value"))).alias("x"))
    return best.select(F.substring_index("group", "|", 1).alias("groupId"), F.expr("substring(group, locate('|', group) + 1)").alias("field"), "x.value", "x.distance")
