"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import glob
import json
import os

import duckdb
import pytest

from chronomark.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return c


def _rows(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in map(tuple, rows)) if not any(None in tuple(r) for r in rows) else sorted((tuple(r[i] for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    found = duck.sql(ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(found.columns)
    assert _rows(df.columns, df.collect()) == _rows(list(found.columns), found.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_same_rows_whatever_the_partitioning(spark):
    from chronomark.operators.timeline import islands, sessions

    rows = [(v, float(t), t, t // 3 % 2) for v in range(3) for t in range(20)]
    a = spark.createDataFrame(rows, "video_id long, t double, seq long, x long")
    from pyspark.sql import functions as F

    for f in (lambda d: islands(d, F.col("x"), ["t"]), lambda d: sessions(d, 5.0)):
        assert sorted(map(tuple, f(a).collect())) == sorted(map(tuple, f(a.repartition(7, "t")).collect()))


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if n.startswith("rpt_")])
def test_reports_have_one_document_an_item(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    assert len({r["video_id"] for r in rows}) == len(rows) > 0


SIX = {"rpt_density": "density", "rpt_pacing": "scenePacing", "rpt_speech": "speech", "rpt_emotion": "emotional", "rpt_overlay": "visualOverlay", "rpt_framing": "personFraming", "rpt_metadata": "metadata"}


@pytest.mark.parametrize("name", sorted(SIX))
def test_reports_have_six_blocks_of_json(spark, name):
    from chronomark.plans.reports import BLOCKS

    df = QUERIES[name](spark, SF)
    assert df.columns == ["video_id", *[SIX[name] + b for b in BLOCKS]]
    for r in df.collect():
        assert all(isinstance(json.loads(r[c]), dict) and json.loads(r[c]) for c in df.columns[1:])


def test_markers_agree_with_their_parts(spark):
    rows = {r["video_id"]: r for r in QUERIES["rpt_markers"](spark, SF).collect()}
    for p in QUERIES["win_local_max"](spark, SF).collect():
        assert (p["rank"], p["sec"], float(p["activity"])) in [(x["rank"], x["sec"], float(x["activity"])) for x in json.loads(rows[p["video_id"]]["peak_moments"])]
    assert all(0 <= x["engagement"] <= 1 for r in rows.values() for x in json.loads(r["engagement_curve"]))
