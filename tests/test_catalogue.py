import os

import duckdb
import pytest

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the test tables are not there")


def cleaned(rows, columns):
    def value(v):
        if v is None or (isinstance(v, float) and v != v):
            return "null"
        return repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(value(r[i]) for i in order) for r in rows)


def names():
    from spherelake.plans import catalogue

    return sorted(catalogue.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", names())
def test_spark_equals_sql(spark, duck, name):
    from spherelake.plans import catalogue

    df = catalogue.queries()[name](spark, DATA)
    got = cleaned([tuple(r) for r in df.collect()], df.columns)
    sql = duck.execute(catalogue.oracle_sql()[name])
    want = cleaned(sql.fetchall(), [c[0] for c in sql.description])
    assert sorted(df.columns) == sorted(c[0] for c in sql.description)
    assert got == want


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["level", "t", "cell", "v"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
