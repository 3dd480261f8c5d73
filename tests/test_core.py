import json
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from codexmill.functions import hashing, text
from codexmill.operators import candidates, catalog, citations, gates, paging
from codexmill.plans import profile
from codexmill.sources import files, sinks
from codexmill.streaming import capture


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect())


@pytest.fixture(scope="module")
def shop(spark):
    books = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "id int, name string")
    langs = spark.createDataFrame([(1, "zh"), (1, "zh"), (2, "zh"), (2, "ja"), (3, None), (3, "zh")], "id int, lang string")
    return books, langs


def test_exact_set_leaves_out_others_and_childless(shop):
    assert rows(catalog.exact_set(*shop, "id", "lang", ["zh"]), "id") == [1, 3]
    assert rows(catalog.exact_set(*shop, "id", "lang", ["zh", "ja"]), "id") == [2]


def test_language_sets_count_the_empty_set(shop):
    got = {(tuple(r["members"]), r["n"]) for r in catalog.top_distribution(catalog.language_sets(*shop, "id", "lang")).collect()}
    assert got == {(("zh",), 2), (("ja", "zh"), 1), ((), 1)}


def test_children_do_not_multiply_each_other(spark, shop):
    books, langs = shop
    names = spark.createDataFrame([(1, "x", 2), (1, "y", None), (1, "z", 1)], "id int, name2 string, pos int")
    whole = catalog.with_children(books, "id", {"langs": (langs, list(catalog.nulls_last("lang")), F.col("lang")), "names": (names, list(catalog.nulls_last("pos")), F.col("name2"))}, required=["langs"])
    by = {r["id"]: r for r in whole.collect()}
    assert by[1]["langs"] == ["zh", "zh"] and by[1]["names"] == ["z", "x", "y"]
    assert by[4]["langs"] is None and by[4]["names"] == []


def test_latest_takes_the_greatest_order(spark):
    df = spark.createDataFrame([(1, 5, "old"), (1, 9, "new"), (2, None, "only")], "k int, v int, x string")
    assert rows(catalog.latest(df, "k", [F.col("v")]), "k", "x") == [(1, "new"), (2, "only")]


def test_one_to_one_names_each_issue(spark):
    a = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    b = spark.createDataFrame([(2,), (3,), (3,), (4,)], "k int")
    assert rows(catalog.one_to_one(a, b, "k"), "k", "issue") == [(1, "missing"), (3, "duplicate"), (4, "unexpected")]


def test_exact_array(spark):
    df = spark.createDataFrame([(["zh", "zh"],), (["zh", "ja"],), ([],), (None,), (["zh", None],)], "x array<string>")
    assert [r[0] for r in df.select(catalog.exact_array("x", ["zh"])).collect()] == [True, False, False, False, True]


@pytest.mark.parametrize("n", [0, -1, 257, 1.5, True, None, "3"])
def test_page_sizes_out_of_bounds(n):
    with pytest.raises(ValueError):
        paging.page_size(n)


def test_pages_join_to_the_whole(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("t"), F.format_string("%04d", "id").alias("i"))
    cursor, got = None, []
    while True:
        batch = paging.page(df, "t", "i", 128, cursor).collect()
        got += [(r["t"], r["i"]) for r in batch]
        if len(batch) < 128:
            break
        cursor = (batch[-1]["t"], batch[-1]["i"])
    assert got == rows(df, "t", "i")
    with pytest.raises(ValueError):
        paging.after("t", "i", (1, None))


def test_positions_are_global_and_total(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("k"))
    got = rows(paging.positions(df, ["k"]), "k", "position")
    assert got == [(i, i) for i in range(5000)]
    assert paging.positions(df.limit(0), ["k"]).count() == 0


def test_disorder_and_gaps(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 5), (1, 3, 6), (2, 1, 1)], "g int, o int, v int")
    assert rows(paging.disorder(df, ["g"], [F.col("o")], F.col("v")), "g", "o") == [(1, 2)]
    assert rows(paging.gaps(spark.createDataFrame([(0,), (1,), (3,), (100001,)], "p int"), "p"), "p", "expected") == [(3, 2), (100001, 4)]


def test_title_forms_use_the_wide_white_space(spark):
    wide = "".join(map(chr, (0x3000, 0xFEFF, 0xA0)))
    df = spark.createDataFrame([(f"Ａ b{wide}C!",), (None,), ("",)], "t string")
    got = [tuple(r) for r in df.select(text.title_key("t"), text.squeezed("t"), text.spaced("t"), text.prefix("t", 2)).collect()]
    assert got == [("abc", "abc!", "a b c!", "ab"), (None,) * 4, ("",) * 4]


def test_one_edit(spark):
    pairs = [("ab", "ab"), ("ab", "ac"), ("ab", "abc"), ("a", "b"), ("abcd", "acbd"), ("日本", "日木"), (None, "ab")]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert [r[0] for r in df.select(text.one_edit("a", "b")).collect()] == [False, True, True, False, False, True, None]


def test_one_edit_pairs_equal_brute_force(spark):
    rng = random.Random(9)
    names = ["".join(rng.choice("ab日") for _ in range(rng.randint(1, 7))) for _ in range(250)] + ["xarper lane", "harper lane", "harperlane", "aab", "ab", None, ""]
    df = spark.createDataFrame([(t,) for t in names], "t string")

    def apart(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    known = sorted({t for t in names if t and len(t) >= 2})
    want = [(a, b) for a in known for b in known if a < b and apart(a, b)]
    assert rows(candidates.one_edit_pairs(df, "t"), "title", "term") == want
    assert ("harper lane", "xarper lane") in want and ("aab", "ab") in want


def test_template_replaces_longest_first(spark):
    u = "01234567-89ab-cdef-0123-456789abcdef"
    df = spark.createDataFrame([(f"{u} has red fox and fox", ["fox", "red fox", ""])], "t string, e array<string>")
    assert df.select(text.template("t", "e")).first()[0] == "<unit> has <evidence> and <evidence>"


def test_leaves_keep_order():
    assert text.string_leaves('{"b": ["x", {"a": "y"}], "a": "z", "n": 1}') == ["x", "y", "z"]
    assert text.string_leaves("no json") == ["no json"] and text.string_leaves(None) is None


def test_excerpt_cuts_code_points(spark):
    df = spark.createDataFrame([(" 　 ",), ("😀" * 300,)], "t string")
    got = [r[0] for r in df.select(text.excerpt("t")).collect()]
    assert got[0] is None and got[1] == "😀" * 240


def test_part_names(spark):
    df = spark.createDataFrame([(42,), (123456,)], "n int")
    assert [r[0] for r in df.select(text.part_name("n")).collect()] == ["part-00042", "part-123456"]
    named = spark.createDataFrame([("x/part-00042.jsonl",), ("part-1.jsonl",)], "f string")
    assert [r[0] for r in named.select(text.part_number("f")).collect()] == [42, None]


def test_hashes_ignore_order_of_keys(spark):
    df = spark.createDataFrame([('{"a": 1, "b": [2.0]}',), ('{"b":[2],"a":1}',), ("{",), (None,)], "j string")
    a, b, c, d = (r[0] for r in df.select(hashing.json_hash("j")).collect())
    assert a == b and c is None and d is None
    with pytest.raises(ValueError):
        hashing.canonical_json(float("nan"))


def test_candidates_equal_brute_force(spark):
    titles = {i: t for i, t in enumerate(["the copper ferry", "the copper fairy", "a glass orchard", "a glass orchid", "xy", None])}
    df = spark.createDataFrame(list(titles.items()), "id int, t string")
    grams = {i: {t[k : k + 3] for k in range(len(t) - 2)} for i, t in titles.items() if t}
    df_of = {g: sum(g in x for x in grams.values()) for x in grams.values() for g in x}
    want = sorted((a, b, round(s, 6)) for a in grams for b in grams if a != b and (n := sum(2 <= df_of[g] <= 50 for g in grams[a] & grams[b])) and (s := n / (len(grams[a]) + len(grams[b]) - n)))
    got = sorted((r["source"], r["candidate"], round(r["score"], 6)) for r in candidates.candidates(df, "id", "t").collect())
    assert got == want


@pytest.mark.parametrize("budget", [0, 3, 10**6])
def test_candidates_with_frequent_ngrams_equal_brute_force(spark, budget):
    rng = random.Random(10)
    titles = ["the red fox " + "".join(rng.choice("abc") for _ in range(rng.randint(0, 5))) for _ in range(60)] + ["the old mill"] * 40 + ["重返" + "".join(rng.choice("金书听鹤") for _ in range(3)) for _ in range(30)] + ["fox", "fox", "书", "", None]
    df = spark.createDataFrame(list(enumerate(titles)), "id int, t string")
    grams = {}
    for i, t in enumerate(titles):
        n = 2 if t and t[-1] > "\u3000" else 6
        if t:
            grams[i] = {t[k : k + n] for k in range(len(t) - n + 1)} or {t}
    want = []
    for a in grams:
        scores = sorted((-len(grams[a] & grams[b]) / len(grams[a] | grams[b]), b) for b in grams if a != b and grams[a] & grams[b])
        want += [(a, b, k, round(-s, 6)) for k, (s, b) in enumerate(scores[:5], 1)]
    got = candidates.candidates(df, "id", "t", n=candidates.by_script("t"), budget=budget, most=5).collect()
    assert sorted((r["source"], r["candidate"], r["rank"], round(r["score"], 6)) for r in got) == sorted(want)


def test_candidates_of_an_ngram_that_all_texts_share(spark):
    n = 20_000
    df = spark.createDataFrame([(i, "重返" + chr(0x4E00 + i % 17_000) + "之" * (i >= 17_000)) for i in range(n)], "id int, t string")
    began = time.monotonic()
    got = {r["source"]: [(x["candidate"], round(x["score"], 6)) for x in sorted(r["x"])] for r in candidates.candidates(df, "id", "t", n=2, most=3).groupBy("source").agg(F.collect_list(F.struct("rank", "candidate", "score")).alias("x")).collect()}
    assert time.monotonic() - began < 120  # one by one they are 400 million pairs
    assert len(got) == n
    # of three-character texts any other shares one of three n-grams, its longer form two of three
    assert got[5_000] == [(0, 0.333333), (1, 0.333333), (2, 0.333333)]
    assert got[7] == [(17_007, 0.666667), (0, 0.333333), (1, 0.333333)]
    assert got[17_007] == [(7, 0.666667), (0, 0.25), (1, 0.25)]


def test_citations(spark):
    normal = lambda c: F.lower(F.trim(F.col(c)))
    d = spark.createDataFrame([(1, [("u", "title", "Red"), ("u", "title", "blue"), ("v", "title", "")])], "k int, citations array<struct<unitId:string,field:string,excerpt:string>>")
    e = spark.createDataFrame([("u", "title", "a red fox"), ("v", "title", "x")], "unitId string, field string, value string")
    assert rows(citations.supported(citations.cited(d, ["k"]), e, ["k"], normal), "place", "found") == [(0, True), (1, False), (2, False)]


def test_linkage(spark):
    df = spark.createDataFrame([(2, [[0], [1]]), (2, [[0]]), (1, [[0, 0]]), (1, [[1]])], "n int, ix array<array<int>>")
    cs = F.array_repeat(F.lit(1), F.col("n"))
    assert [r[0] for r in df.select(citations.linkage(cs, F.col("ix"))).collect()] == [None, "unused", "repeated", "missing"]


def test_subsets_are_proper_and_bounded(spark):
    got = citations.subsets(spark.createDataFrame([(3,), (1,)], "k int"), "k").collect()
    assert sorted(r["mask"] for r in got) == [1, 2, 3, 4, 5, 6] and all(bin(r["mask"]).count("1") == r["items"] for r in got)
    with pytest.raises(Exception, match="too many"):
        citations.subsets(spark.createDataFrame([(40,)], "k int"), "k").collect()


def test_gates(spark):
    df = spark.createDataFrame([(1, "a")] * 3 + [(1, "b"), (2, None), (2, None), (2, None)], "p int, t string")
    assert rows(gates.repeated_text(df, ["p"], F.col("t")), "p", "n") == [(1, 3)]
    assert rows(gates.uniform(df, ["p"], F.col("t").isNotNull(), 3), "p") == [1]
    flags = df.limit(1).select(gates.flags([("x", F.lit(True)), ("y", F.lit(None).cast("boolean"))]), gates.violations([("x", F.lit(True)), ("y", F.lit(None).cast("boolean"))])).first()
    assert flags[0] == ["x"] and flags[1] == ["y"]


def test_json_lines_strict_and_not(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"id":"x","n":1}\n\n{"id":"y z","n":2}\nbroken\n')
    schema = StructType([StructField("id", StringType()), StructField("n", LongType())])
    loose = files.json_lines(spark, str(p), schema, strict=False)
    assert sorted(r["n"] or 0 for r in loose.collect()) == [0, 1, 2] and loose.where("_error is not null").count() == 1
    with pytest.raises(Exception, match="contract"):
        files.json_lines(spark, str(p), schema).collect()
    assert rows(files.numbered_lines(spark, str(p)), "line") == [1, 3, 4]


def test_decision_files_of_three_shapes(spark, tmp_path):
    schema = StructType([StructField("id", StringType())])
    for name, body in (("a", '[{"id":"1"},{"id":"2"}]'), ("b", '{"id":"1"}'), ("c", '{"id":"1"}\n{"id":"2"}\n')):
        (tmp_path / name).write_text(body)
    assert [files.decision_rows(spark, str(tmp_path / n), schema).count() for n in "abc"] == [2, 1, 2]


def test_sources_and_paths(spark, tmp_path):
    assert rows(files.id_list(spark, '["b","a","b",null]'), "id") == ["a", "b"]
    with pytest.raises(Exception):
        files.id_list(spark, "{oops").collect()
    (tmp_path / "q.sql").write_text("select :a + 1 as x")
    assert files.statement(spark, str(tmp_path / "q.sql"), a=2).first()[0] == 3
    for n in (99999, 100000, 7):
        (tmp_path / f"part-{n:05d}.jsonl").write_text("{}")
    assert [n for n, _ in files.part_files(str(tmp_path))] == [7, 99999, 100000]
    with pytest.raises(ValueError):
        files.inside(str(tmp_path), "../x")
    with pytest.raises(ValueError):
        files.jdbc(spark, {"url": "jdbc:x"}, "t", "q")


def test_sinks(spark, tmp_path):
    df = spark.range(3)
    sinks.write_part(df, str(tmp_path / "t"), 0)
    with pytest.raises(Exception):
        sinks.write_part(df, str(tmp_path / "t"), 0)
    with pytest.raises(ValueError):
        sinks.write_part(df.limit(0), str(tmp_path / "t"), 1)
    sinks.write_once(df, str(tmp_path / "m"), df.limit(0))
    with pytest.raises(ValueError):
        sinks.write_once(df, str(tmp_path / "m2"), df)
    assert sinks.write_summary(df.agg(F.count("*").alias("n")), str(tmp_path / "s.json")) == {"n": 3}
    sinks.append_event(str(tmp_path / "e"), "x", rows=1)
    sinks.append_event(str(tmp_path / "e"), "y")
    assert [json.loads(x)["event"] for x in (tmp_path / "e").read_text().splitlines()] == ["x", "y"]
    assert not list(tmp_path.glob("*.tmp"))


def test_capture_in_pages_equals_the_batch_and_recovers(spark, tmp_path):
    df = spark.range(300).select((F.col("id") % 11).alias("t"), F.format_string("%04d", "id").alias("i"))
    folder = str(tmp_path / "cap")
    first = capture.capture_page(df, folder, "t", "i", 100)
    assert {k: first[k] for k in ("part", "rows", "complete")} == {"part": 0, "rows": 100, "complete": False}
    (tmp_path / "cap.state.json").unlink()  # as after a crash before it was noted
    got = capture.capture_all(df, folder, "t", "i", 100)
    assert rows(got.select("t", "i"), "t", "i") == rows(df, "t", "i")
    assert capture.checkpoint(spark, folder, "t", "i")["rows"] == 300
    with capture.locked(spark, str(tmp_path / "l")), pytest.raises(RuntimeError), capture.locked(spark, str(tmp_path / "l")):
        pass


def test_capture_of_many_pages_is_one_pass(spark, tmp_path):
    df = spark.range(3_000).select((F.col("id") % 7).alias("t"), F.format_string("%04d", "id").alias("i"))
    one, all_ = str(tmp_path / "one"), str(tmp_path / "all")
    for size in (10, 11):
        tracker, before = spark.sparkContext.statusTracker(), len(spark.sparkContext.statusTracker().getJobIdsForGroup())
        got = capture.capture_all(df, f"{all_}{size}", "t", "i", size, cutoff=4)
        assert len(tracker.getJobIdsForGroup()) - before < 30  # a page took several
        order = {r["i"]: k // size for k, r in enumerate(df.where("t <= 4").orderBy("t", "i").collect())}
        assert rows(got, "i", "part") == sorted(order.items())
        assert capture.noted(spark, f"{all_}{size}", "t", "i") | {"last": 0} == capture.checkpoint(spark, f"{all_}{size}", "t", "i") | {"last": 0}
        assert not (tmp_path / f"all{size}.pages").exists()
    few = df.where("i < '0014'")
    for size in (5, 7):
        while not capture.capture_page(few, f"{one}{size}", "t", "i", size)["complete"]:
            pass
        capture.capture_all(few, f"{one}{size}-all", "t", "i", size)
        assert capture.read_state(spark, f"{one}{size}-all") == capture.read_state(spark, f"{one}{size}")


def test_streams(spark, tmp_path):
    src = str(tmp_path / "src")
    rowset = spark.sql("select timestamp'2025-01-01 00:00:00' + make_interval(0,0,0,0,0,cast(id as int),0) as ts, cast(id % 2 as string) as k from range(600)")
    rowset.repartition(3).write.parquet(src)
    assert capture.stream_files(spark, src, rowset.schema, str(tmp_path / "o"), str(tmp_path / "c")) == 600
    assert capture.stream_files(spark, src, rowset.schema, str(tmp_path / "o"), str(tmp_path / "c")) == 0
    assert spark.read.parquet(str(tmp_path / "o")).count() == 600
    capture.stream_counts(spark, src, rowset.schema, "k", "ts", "1 minute", "1 hour", str(tmp_path / "w"), str(tmp_path / "wc"))
    counted = spark.read.parquet(str(tmp_path / "w"))
    assert counted.agg(F.sum("n")).first()[0] % 60 == 0


def test_pending_and_status(spark):
    parts = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c")], "part int, source string")
    done = spark.createDataFrame([(0, "a"), (0, "b")], "part int, source string")
    assert rows(capture.pending(parts, done), "source") == ["c"]
    assert capture.status(parts, done).first().asDict() == {"sources": 3, "decisions": 2, "remaining": 1, "complete": False}


def test_profile(spark):
    df = spark.range(10).groupBy((F.col("id") % 2).alias("k")).count()
    assert profile.profile(df)["operators"].get("Exchange") == 1
    profile.bounded(df)
    with pytest.raises(AssertionError):
        profile.bounded(spark.range(3).crossJoin(spark.range(3).withColumnRenamed("id", "x")))
    assert profile.probe(df)["rows"] == 2


def test_written_tables_are_read_back_and_cleared(spark):
    from codexmill.session import clear_written, drop_written, written

    a, b = written(spark.range(5)), written(spark.range(0))
    assert a.count() == 5 and b.count() == 0 and "file" in a.inputFiles()[0]
    drop_written(spark, a)
    drop_written(spark, b)
    c = written(spark.range(3))
    files = c.inputFiles()
    clear_written(spark)
    from pathlib import Path

    assert not Path(files[0].replace("file://", "")).exists()
