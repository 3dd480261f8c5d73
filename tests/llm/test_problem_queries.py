"""The queries of the ten problems: columns, SQL where there is some, and no repeats."""

from pathlib import Path

import pytest

from codexmill.llm import queries, sql

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")
COLUMNS = {
    "p1_found": ["unitId", "groupId"], "p2_found": ["locId"], "p3_found": ["groupId", "unitId"], "p4_found": ["creditedUnitIdA", "creditedUnitIdB"], "p5_found": ["unitIdA", "unitIdB"],
    "p6_found": ["locId", "lang"], "p7_found": ["locIdA", "locIdB"], "p9_found": ["doc_id", "item_id"], "p10_found": ["doc_id"],
}


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, name):
    got = queries.queries()[name](spark, str(DATA))
    rows = [tuple(r) for r in got.collect()]
    if name in COLUMNS:
        assert got.columns == COLUMNS[name]
        assert len(rows) == len(set(rows))
    if name in sql.oracle_sql():
        duckdb = pytest.importorskip("duckdb")
        c = duckdb.connect()
        c.execute("set timezone = 'UTC'")
        for p in DATA.glob("*.parquet"):
            c.execute(f"create view {p.stem} as select * from '{p}'")
        cursor = c.execute(sql.oracle_sql()[name])
        names = [x[0] for x in cursor.description]
        assert sorted(tuple(r[names.index(c)] for c in got.columns) for r in cursor.fetchall()) == sorted(rows)
