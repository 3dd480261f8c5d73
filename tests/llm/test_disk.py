"""What lies on disk while near duplicates are sought."""

import os
import time

import numpy as np
from pyspark.sql import functions as F

from codexmill.llm import neardup
from codexmill.session import CLEANUP, shared_dir, written

KIND = "locId long, unitId string, summary string, description string, capturedAt string, updatedAt string"


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return {f for f in files if f.rsplit("/", 1)[-1].startswith("shuffle_")}


def tables(spark):
    return set(os.listdir(shared_dir(spark).removeprefix("file://")))


def test_shuffle_files_of_a_written_table_go_with_its_end(spark):
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP)
    df = written(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count().orderBy("k"))
    until = time.monotonic() + 10
    while (left := shuffle_files(spark) - before) and time.monotonic() < until:
        time.sleep(0.2)
    assert not left
    assert [r["count"] for r in df.collect()] == [143] * 6 + [142]
    assert spark.conf.get(CLEANUP) == setting


def test_bands_take_few_bytes():
    rng = np.random.default_rng(1)
    # ids as they come from 50 tasks, in their order
    ids = np.repeat(np.sort((rng.integers(0, 50, 4000) << 33) + rng.choice(20_000, 4000, replace=False)), 48)
    bands = rng.integers(0, 2**64, len(ids), dtype=np.uint64)
    sent = neardup.packed(bands, ids, 96)
    assert sum(map(len, sent.column(1).to_pylist())) <= 9.5 * len(ids)
    back = [np.stack([b.astype(np.int64), i]) for b, i in (neardup.unpacked(c, d) for c, d in zip(*(c.to_pylist() for c in sent.columns), strict=True))]
    want = np.stack([((bands >> np.uint64(48)) * np.uint64(96) >> np.uint64(16) << np.uint64(32) | bands & np.uint64(0xFFFFFFFF)).astype(np.int64), ids])
    order = lambda x: x[:, np.lexsort(x)]
    assert (order(np.concatenate(back, axis=1)) == order(want)).all()


def test_ids_in_any_order_come_back():
    ids = np.array([2**62, -(2**62), 0, 2**63 - 1, -(2**63), 5, 5], np.int64)
    for cells in (1, 16, 1 << 16):
        sent = neardup.packed(np.arange(7, dtype=np.uint64) << np.uint64(61), ids, cells)
        assert sorted(int(i) for c, d in zip(*(c.to_pylist() for c in sent.columns), strict=True) for i in neardup.unpacked(c, d)[1]) == sorted(ids.tolist())


def test_texts_without_shingles_have_no_bands(spark):
    assert neardup.packed(np.zeros(0, np.uint64), np.zeros(0, np.int64), 16).num_rows == 0
    rows = [(i, f"u{i}", "!" * (i + 1), None, "t", "t") for i in range(4)]
    assert neardup.near_duplicates(spark.createDataFrame(rows, KIND)).count() == 0


def test_tables_go_when_nothing_reads_them(spark):
    text = "under the bridge the keeper of the lantern counts every boat that passes before dawn and after dusk"
    rows = [(1, "u1", text, None, "t", "t"), (2, "u2", text + " again", None, "t", "t"), (3, "u3", text.upper(), None, "t", "t"), (4, "u4", "nothing of that kind stands here", None, "t", "t")]
    before = tables(spark)
    members, links = neardup.near_duplicate_classes(spark.createDataFrame(rows, KIND))
    assert sorted(x.split("-")[0] for x in tables(spark) - before) == ["known", "members", "met", "pairs"]
    assert members.count() == 4 and [(r["a"] < r["b"], r["similarity"] > 0.5) for r in links.collect()] == [(True, True)]
