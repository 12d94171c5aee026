import duckdb
import pytest

from pktloom.plans.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM '{SF}/events.parquet'")
    return c


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    if name not in ORACLE_SQL:
        assert got
        return
    rel = con.sql(ORACLE_SQL[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=str)
    assert got == want and got


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", ["canonical_key", "unit_us_to_ns", "rule_time_parse", "rule_first_match", "flow_csv"])
def test_other_time_zone(spark, con, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        test_query(spark, con, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
