"""Problems 1 and 3."""

import random

import pytest

from codexmill.llm import components, consensus


def brute(pairs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("shape", ["random", "chain", "star", "cycle"])
@pytest.mark.parametrize("cell", [3, 17, 1000])
def test_components_equal_brute_force(spark, shape, cell):
    rng = random.Random(5)
    name = [f"{rng.random():.12f}" for _ in range(90)]
    pairs = {
        "random": [(rng.choice(name), rng.choice(name)) for _ in range(60)],
        "chain": list(zip(name, name[1:], strict=False)),
        "star": [(n, name[7]) for n in name],
        "cycle": list(zip(name, name[1:] + name[:1], strict=True)),
    }[shape]
    if cell == 3 and shape in ("chain", "cycle"):
        pairs = pairs[:30]
    df = spark.createDataFrame(pairs, "s string, t string")
    got = {r["id"]: r["group"] for r in components.connected(df, "s", "t", cell).collect()}
    assert got == brute([p for p in pairs if p[0] != p[1]])


def test_merge_groups_cases(spark, clash):
    rows = [("A ", "b", "merge"), ("a", "B", "merge"), ("b", None, "merge"), (None, "b", "merge"), ("c", "c", "merge"), ("d", "e", "keep"), ("", "b", "merge"), ("b", "z" * 5000, "merge")]
    df = clash(spark.createDataFrame(rows, "sourceUnitId string, targetUnitId string, disposition string"))
    got = {(r["unitId"], r["groupId"]) for r in components.merge_groups(df).collect()}
    assert got == {("a", "a"), ("b", "a"), ("z" * 5000, "a")}
    assert components.merge_groups(df.limit(0)).count() == 0


def test_alignment():
    assert consensus.trace(["a", "b"], ["a", "x", "b"]) == [(0, 0), (None, 1), (1, 2)]
    assert consensus.distance(["k:1"], ["k:2"]) == 1
    made, _, _ = consensus.progressive([(["the", "red", "fox"], [0.0] * 3, 1.0), (["the", "fox"], [0.0] * 2, 1.0), (["the", "red", "fix"], [0.0] * 3, 1.0), (["the", "red", "fox"], [0.0] * 3, 1.0)])
    assert made == ["the", "red", "fox"]


@pytest.mark.parametrize("chunk", [2, 64])
def test_consensus_takes_the_value_nearest_to_the_vote(spark, clash, chunk):
    values = ["the red fox", "the red fox", "a red fox", "the red fix", "the fox"]
    rows = [("g", f"u{i}", v.split(), [0.0] * len(v.split()), 1.0) for i, v in enumerate(values)]
    rows += rows[:1] + [(None, "u", ["x"], [0.0], 1.0), ("h", "only", [], [], 1.0), ("h", None, ["x"], [0.0], 1.0)]
    df = clash(spark.createDataFrame(rows, "group string, unit string, tokens array<string>, merits array<double>, weight double"))
    got = {r["unit"]: r["distance"] for r in consensus.consensus(df, chunk).collect() if r["group"] == "g"}
    assert got == {"u0": 0, "u1": 0, "u2": 1, "u3": 1, "u4": 1}
    assert consensus.consensus(df.limit(0), chunk).count() == 0


def test_merit_beats_any_number_of_votes(spark):
    rows = [("g", f"u{i}", ["langs:1"], [1.0], 1.0) for i in range(9)] + [("g", "best", ["langs:2"], [2.0], 1.0)]
    df = spark.createDataFrame(rows, "group string, unit string, tokens array<string>, merits array<double>, weight double")
    assert [r["unit"] for r in consensus.consensus(df).where("distance = 0").collect()] == ["best"]


def test_isbn(spark):
    df = spark.createDataFrame([("978-0-306-40615-7",), ("9780306406158",), ("9770306406157",), ("",), (None,), ("978 0 306 40615 7",)], "i string")
    assert [r[0] for r in df.select(consensus.usable_isbn("i")).collect()] == [True, False, False, False, False, True]


def test_clear_survivors(spark):
    groups = spark.createDataFrame([("a", "g"), ("b", "g"), ("c", "h"), ("d", "h"), ("e", "k"), ("f", "k")], "unitId string, groupId string")
    book = "id string, createdAt string, updatedAt string, capturedAt timestamp, details struct<isbn13:string,pageCount:int>"
    t = "2024-01-01T00:00:00Z"
    rows = [("A", t, t, None, ("9780306406157", 5)), ("b", "2024-01-01T00:00:00+01:00", t, None, (None, -1)), ("c", t, t, None, (None, 3)), ("d", "2024-02-01T00:00:00Z", t, None, (None, None)), ("e", t, t, None, None), ("f", t, t, None, None)]
    loc = spark.createDataFrame([("a", "zh", 1), ("a", "", 2), ("b", None, 3)], "unitId string, language string, locId long")
    got = [tuple(r) for r in consensus.clear_survivors(groups, spark.createDataFrame(rows, book), loc).collect()]
    assert got == [("g", "a")]


FIELDS = "id string, updatedAt string, moderationStatus string, details struct<isbn13:string,pageCount:int,publicationDate:string,releaseStatus:string>"


def test_surviving_values(spark):
    groups = spark.createDataFrame([(u, "g") for u in "abcd"], "unitId string, groupId string")
    t, ok = "2024-01-01T00:00:00Z", "approved"
    rows = [("a", t, ok, ("978-0-306-40615-7", 10, "2020-01-02", None)), ("b", t, ok, ("9780306406157", 10, "2020-01-03", " ")), ("c", t, ok, ("9780306406158", -1, "2020-01-02", None)), ("d", None, None, None)]
    got = {r["field"]: r["value"] for r in consensus.surviving_values(groups, spark.createDataFrame(rows + rows[:1], FIELDS)).collect()}
    assert got == {"isbn13": "9780306406157", "pageCount": "10", "publicationDate": "2020-01-02"}
    assert consensus.surviving_values(groups.limit(0), spark.createDataFrame(rows, FIELDS)).count() == 0


def test_votes_weigh_trust_and_recency(spark):
    groups = spark.createDataFrame([(u, "g") for u in ("a", "b", "c", "d", "e")], "unitId string, groupId string")
    new, old = "2024-01-01T00:00:00Z", "2014-01-01T00:00:00Z"
    isbn = "9780306406157"
    rows = [("a", new, "approved", (isbn, 7, None, None)), ("b", old, "pending", (None, 9, None, None)), ("c", old, "pending", (None, 9, None, None)), ("d", None, None, (None, 9, None, None)), ("e", new, "approved", (isbn, 7, None, None))]
    titles = [(1, "a", "EN", "The  Red Fox of Oak"), (2, "b", "en", "The Red Fix of Oak"), (3, "c", "en", "A Red Fox of Oak"), (4, "d", "en", "Fox"), (5, "e", "en", "The Red Fox of Elm"), (6, "a", "zh", "红狐狸传"), (7, "b", "zh", "红狐理传"), (8, "c", "zh", "红狐狸"), (9, "e", "", "x"), (10, "e", "de", " "), (11, "e", "zh", None)]
    loc = spark.createDataFrame(titles, "locId long, unitId string, language string, title string")
    got = {r["field"]: r["value"] for r in consensus.surviving_values(groups, spark.createDataFrame(rows, FIELDS), loc).collect()}
    # two trusted and recent books outvote three that are neither; the tokens of several titles make up the winner
    assert got == {"isbn13": isbn, "pageCount": "7", "title:en": "The Red Fox of Oak", "title:zh": "红狐狸传"}
