"""Contracts, packets, the page reader, audit, workers, capture across crashes, measured plans and the command line."""

import json
import os
import socket

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from codexmill.__main__ import main
from codexmill.functions import text
from codexmill.operators import audit, citations, contracts, evidence, packets, paging, workers
from codexmill.plans import profile
from codexmill.sources import files, sinks
from codexmill.streaming import capture


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_contracts(spark):
    df = spark.createDataFrame([("a", 3, ["x"], "open"), (None, -1, [], "odd"), ("bb", None, None, None)], "id string, n int, l array<string>, s string")
    rules = [("id", contracts.sized("id", 1, 1)), ("n", contracts.optional("n", F.col("n") > 0)), ("l", contracts.counted("l", 1, 2)), ("s", contracts.one_of("s", ["open", "shut"])), ("shape", contracts.shaped("id", "^[a-z]$"))]
    got = {r["id"]: r["violations"] for r in contracts.checked(df, rules).collect()}
    assert got == {"a": [], None: ["id", "n", "l", "s", "shape"], "bb": ["id", "l", "s", "shape"]}
    assert contracts.strict(df.where("id = 'a'"), rules).count() == 1
    with pytest.raises(Exception, match="breaks: id"):
        contracts.strict(df, rules).collect()
    keys = spark.createDataFrame([('{"a":1,"z":2,"b":3}',), ("[1]",), (None,)], "j string").select(contracts.unknown_keys("j", ["a"]).alias("k"))
    assert [r["k"] for r in keys.collect()] == [["b", "z"], None, None]
    assert contracts.checked(df.limit(0), rules).count() == 0


def test_consistency_and_bindings(spark):
    df = spark.createDataFrame([(1, "a", "a"), (2, "a", "b"), (3, None, None), (4, None, "x")], "k int, s string, t string")
    assert rows(contracts.inconsistent(df, "k", {"f": (F.col("s"), F.col("t"))}), "k", "field") == [(2, "f"), (4, "f")]
    named = spark.createDataFrame([(1, ["a", "q", "q", None]), (2, None), (3, [])], "k int, ids array<string>")
    known = spark.createDataFrame([("a",)], "id string")
    assert rows(contracts.bound(named, known, {"c": F.coalesce("ids", F.array().cast("array<string>"))}, ["k"]), "k", "code", "id") == [(1, "c", "q")]


def test_packets(spark):
    sources = spark.createDataFrame([(i, f"s{i:02d}") for i in range(7)], "t int, id string")
    packs = packets.packets(sources, ["t", "id"], "id", "r", 3)
    assert [len(r["sources"]) for r in packs.orderBy("part").collect()] == [3, 3, 1]
    with pytest.raises(ValueError):
        packets.packets(sources, ["t"], "id", "r", 21)
    links = spark.createDataFrame([("s00", "c1"), ("s01", "c1"), ("s00", "c2"), ("s00", "s01"), ("s02", "gone"), ("s00", "c3")], "source string, candidate string")
    facts = spark.createDataFrame([("c1", 1), ("c2", 5), ("c3", 1), ("s01", 9)], "id string, q int")
    ranked = packets.ranked_candidates(packs, links, facts, [F.desc("q")], most=5)
    assert [r["candidate"] for r in ranked.where("part = 0").orderBy("rank").collect()] == ["s00", "s01", "s02", "c2", "c1"]
    whole = packets.review_packets(packs, ranked, spark.createDataFrame([("s00", ["x"])], "id string, flags array<string>"))
    first = whole.where("part = 0").first()
    assert first["signals"] == {"s00": ["x"], "s01": [], "s02": []}
    bad = whole.withColumn("candidates", F.when(F.col("part") == 0, F.array(F.lit("s00"))).otherwise(F.col("candidates"))).withColumn("packetId", F.when(F.col("part") == 1, "x").otherwise(F.col("packetId")))
    got = {r["part"]: r["p"] for r in bad.select("part", packets.packet_problems(bad, "r").alias("p")).collect()}
    assert got == {0: ["source_not_candidate", "input_hash"], 1: ["packet_id", "input_hash"], 2: []}
    assert packets.packets(sources.limit(0), ["t", "id"], "id", "r").count() == 0


def test_evidence_page(spark):
    sources = spark.createDataFrame([(i, f"s{i}") for i in range(5)], "t int, id string")
    links = spark.createDataFrame([("s1", "c1", 0.5), ("s1", "c0", 0.5), ("s1", "c2", 0.9), ("s2", "gone", 1.0)], "source string, candidate string, score double")
    ev = spark.createDataFrame([(x, x.upper()) for x in ("s1", "s2", "s3", "c0", "c1", "c2")], "id string, v string")
    got = evidence.evidence_page(sources, links, ev, "t", "id", 2, (0, "s0"), cutoff=3, most=2)
    assert rows(got, "source", "unit", "rank") == [("s1", "c0", 2), ("s1", "c2", 1), ("s1", "s1", 0), ("s2", "s2", 0)]
    assert got.where("unit = 'c2'").first()["evidence"]["v"] == "C2"
    with pytest.raises(Exception, match="no evidence: s4"):
        evidence.evidence_page(sources, links, ev, "t", "id", 2, (3, "s3")).collect()
    assert evidence.evidence_page(sources, links, ev, "t", "id", 2, (3, "s3"), cutoff=3).count() == 0
    with pytest.raises(ValueError):
        paging.page(sources, "t", "id", 257)


def test_audit(spark):
    a, b = spark.createDataFrame([("x",), ("y",), (None,)], "id string"), spark.createDataFrame([(f"k{i:02d}",) for i in range(30)], "u string")
    issues = audit.united({"one": (a, "id"), "two": (b, "u")})
    got = {r["code"]: (r["n"], len(r["ids"])) for r in audit.report(issues).collect()}
    assert got == {"one": (3, 2), "two": (30, 20)}
    assert ("issue", "two", None, 30) in [tuple(r) for r in audit.quality_report(a, issues, ["id"]).collect()]
    assert audit.report(issues.limit(0)).count() == 0


def test_workers_retry_only_what_is_rejected(spark):
    def picky(items, feedback):
        if any(i["id"] == "boom" for i in items):
            raise RuntimeError("no answer")
        if any(i["id"] == "dead" for i in items):
            raise workers.Fatal("no key")
        return {i["id"]: {"v": len(feedback.get(i["id"], ""))} if i["id"] != "odd" or i["id"] in feedback else workers.Rejected("again") for i in items if i["id"] != "never"}

    schema = StructType().add("v", "integer")
    run = lambda ids: {r["id"]: (r["attempts"], r["error"], r["v"]) for r in workers.decided(spark.createDataFrame([(i,) for i in ids], "id string").coalesce(1), picky, schema, batch=2, pause=lambda s: None).collect()}
    assert run(["a", "odd", "never", "b"]) == {"a": (1, None, 0), "odd": (2, None, 5), "never": (3, "rejected: no result", None), "b": (1, None, 0)}
    assert run(["dead", "c", "d", "e"]) == {"dead": (1, "fatal: no key", None), "c": (1, "fatal: no key", None), "d": (1, None, 0), "e": (1, None, 0)}
    assert run(["boom"]) == {"boom": (3, "rejected: no answer", None)}
    assert [workers.backoff(n, False) for n in (1, 2, 3, 4, 5)] == [0.25, 0.5, 1.0, 2.0, 2.0] and workers.backoff(2, True) == 10.0
    assert workers.decided(spark.createDataFrame([], "id string"), picky, schema).count() == 0
    with pytest.raises(ValueError):
        workers.decided(spark.createDataFrame([], "id string"), picky, schema, batch=0)


def test_capture_survives_crashes(spark, tmp_path):
    df = spark.range(25).select((F.col("id") % 7).alias("t"), F.format_string("%03d", "id").alias("i"))
    folder = str(tmp_path / "cap")
    capture.capture_page(df, folder, "t", "i", 10, cutoff=5)
    note = (tmp_path / "cap.state.json").read_text()
    capture.capture_page(df, folder, "t", "i", 10, cutoff=5)
    capture._write(spark, f"{folder}.state.json", note)  # the second part was written but not noted
    assert capture.noted(spark, folder, "t", "i") == capture.checkpoint(spark, folder, "t", "i")
    (tmp_path / "cap" / "part=2").mkdir()  # an attempt that didn't end
    with pytest.raises(ValueError, match="one cutoff"):
        capture.capture_page(df, folder, "t", "i", 10)
    got = capture.capture_all(df, folder, "t", "i", 10, cutoff=5)
    assert rows(got, "t", "i") == rows(df.where("t <= 5"), "t", "i")
    assert capture.successor_start(spark, folder, "t", "i", 5) == (5, "019")
    with pytest.raises(ValueError, match="cutoff"):
        capture.successor_start(spark, folder, "t", "i", 6)
    none = capture.capture_all(df.limit(0), str(tmp_path / "none"), "t", "i", 10)
    assert none.count() == 0 and "part" in none.columns


def test_locks_of_dead_owners_are_taken_over(spark, tmp_path):
    lock = tmp_path / "l"
    lock.write_text(f"{socket.gethostname()} 999999999")
    with capture.locked(spark, str(lock)):
        assert lock.read_text() == f"{socket.gethostname()} {os.getpid()}"
    assert not lock.exists()
    lock.write_text("elsewhere 1")
    with pytest.raises(RuntimeError, match="elsewhere"), capture.locked(spark, str(lock)):
        pass


def test_progress(spark):
    parts = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c"), (1, "d"), (2, "e")], "part int, source string")
    done = lambda *s: spark.createDataFrame([(x,) for x in s], "source string")
    assert tuple(capture.progress(parts, done("a", "b", "c", "e")).first()) == (0, 1, 1)
    assert tuple(capture.progress(parts, done(*"abcde")).first()) == (2, None, 0)
    assert tuple(capture.progress(parts.limit(0), done("a")).first()) == (-1, None, 0)
    assert rows(capture.next_batch(parts, done("a", "b"), 9), "part", "source") == [(1, "c"), (1, "d")]
    assert capture.next_batch(parts, done(*"abcde"), 9).count() == 0


def test_lines_with_their_numbers(spark, tmp_path):
    schema = StructType([StructField("id", StringType()), StructField("n", LongType())])
    p = tmp_path / "a.jsonl"
    p.write_text('{"id":"x","n":1}\n\n{"id":"y","m":2}\nbroken\n{"id":"z","n":"k"}\n')
    assert [(r["line"], r["problem"]) for r in files.bad_lines(spark, str(p), schema).orderBy("line").collect()] == [(3, "unknown keys: m"), (4, "doesn't fit"), (5, "doesn't fit")]
    with pytest.raises(ValueError, match="line 3"):
        files.checked_lines(spark, str(p), schema)
    p.write_text('{"id":"x","n":1}\n')
    assert files.checked_lines(spark, str(p), schema).count() == 1
    (tmp_path / "d.json").write_text('{"a":1}')
    assert files.json_document(str(tmp_path / "d.json"), ["a"]) == {"a": 1}
    with pytest.raises(ValueError):
        files.json_document(str(tmp_path / "d.json"), ["b"])
    (tmp_path / "m").write_text('{\n "id": "1"\n}')
    (tmp_path / "e").write_text("5")
    assert files.decision_rows(spark, str(tmp_path / "m"), schema).count() == 1
    with pytest.raises(ValueError):
        files.decision_rows(spark, str(tmp_path / "e"), schema)


def test_all_checks_come_before_any_row_is_recorded(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    path = str(tmp_path / "t")
    assert sinks.record(df, path, "k") == 2
    for more, problems in ((df.limit(1), None), (spark.createDataFrame([("c", 1), ("c", 2)], "k string, v int"), None), (spark.createDataFrame([("d", 1)], "k string, v int"), df)):
        with pytest.raises(ValueError):
            sinks.record(more, path, "k", problems)
    assert spark.read.parquet(path).count() == 2
    sinks.write_schema(df, str(tmp_path / "s.json"), [("v", F.col("v") > 0)])
    assert json.loads((tmp_path / "s.json").read_text())["rules"][0]["code"] == "v"


def test_field_values_and_first_valid(spark):
    df = spark.createDataFrame([("u", "a", ["b", None], 3), ("v", None, None, None)], "id string, x string, y array<string>, n int")
    assert rows(text.field_values(df, "id", {"x": "x", "y": "y", "n": "n"}), "unitId", "field", "value") == [("u", "n", "3"), ("u", "x", "a"), ("u", "y", "b")]
    c = spark.createDataFrame([("a", 3, 0), ("b", 3, 2), ("c", 2, 3), ("d", 1, 0)], "k string, n int, bad long")
    assert rows(citations.first_valid(c, ["k"], "n", F.expr("(mask & bad) = 0")), "k", "mask", "items") == [("a", 7, 3), ("b", 5, 2), ("d", 1, 1)]


def test_measured_plans(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 4 as k").write.parquet(str(tmp_path / "t.parquet"))
    df = spark.read.parquet(str(tmp_path / "t.parquet")).where("id < 50").groupBy("k").count()
    found = profile.bounded_rows(df, 100)
    assert {50, 4} <= {x["rows"] for x in found} and found[0]["depth"] == 0
    with pytest.raises(AssertionError):
        profile.bounded_rows(df, 49)
    assert profile.doctor(spark, {"t": ["id"], "u": ["id"]}, str(tmp_path))[0][0] == "u"
    assert profile.doctor(spark, {"t": ["zz"]}, str(tmp_path)) == [("t", "lacks zz")]


def test_command_line(spark, tmp_path, capsys):
    if not os.path.exists("/root/testdata/sf0.001"):
        pytest.skip("no test tables")
    say = lambda *a: (main([*a], spark), json.loads(capsys.readouterr().out.strip().split("\n")[-1]))
    data, run = "/root/testdata/sf0.001", str(tmp_path / "run")
    assert say("doctor", data)[0] == 0 and say("doctor", str(tmp_path))[0] == 1
    assert say("init", run, data, "--page", "40", "--cutoff", "2025-06-01 00:00:00+00:00")[1]["page"] == 40
    with pytest.raises(FileExistsError):
        main(["init", run, data], spark)
    with pytest.raises(ValueError):
        main(["init", run + "2", data, "--page", "999"], spark)
    pages = [say("next", run)[1]]
    while not pages[-1]["complete"]:
        pages.append(say("next", run)[1])
    assert say("status", run)[1]["capture"]["total"] == sum(p["rows"] for p in pages) > 0
    assert say("audit", data)[1] and say("inventory", data)[1]["summary"]
    assert say("probe", data, "quality_counters")[1]["rows"] > 0
