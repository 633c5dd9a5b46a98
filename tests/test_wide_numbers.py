"""Reads of tables so large that their numbers don't fit 64 bits."""

import duckdb
import pytest

import __spark_entry__ as se
from catalog.fixtures import WIDE_FROM, spark_fixture

SOURCE = "/root/testdata/sf0.001"
KEYS = {"lineitem": "l_orderkey", "orders": "o_orderkey"}


@pytest.fixture(scope="module")
def far(spark, tmp_path_factory):
    """The smallest tables twice, the copy with order keys as in 360 copies of sf0.1."""
    path = str(tmp_path_factory.mktemp("far"))
    for table in ("customer", "lineitem", "orders", "part", "supplier"):
        rows = spark.read.parquet(f"{SOURCE}/{table}.parquet")
        if table in KEYS:
            rows = rows.unionByName(rows.withColumn(KEYS[table], rows[KEYS[table]] + 359 * 150_000))
        rows.coalesce(1).write.parquet(f"{path}/{table}.parquet")
    return path


def exact(path, name):
    """The oracle's rows with its read numbers in 128 bits: in 64 its arithmetic overflows too."""
    con = duckdb.connect()
    for table in ("customer", "lineitem", "orders", "part", "supplier"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet/*.parquet'")
    sql = se.oracle_sql()[name]
    with pytest.raises(duckdb.OutOfRangeException):
        con.execute(sql).fetchall()
    return con.execute(sql.replace("(l_orderkey * 10 +", "(cast(l_orderkey AS HUGEINT) * 10 +", 1))


@pytest.mark.parametrize("name", ["fx_crop_insert", "fx_read_name", "join_barcode_hamming_k", "agg_demux_funnel"])
def test_numbers_beyond_64_bits_are_exact(spark, far, name):
    want = exact(far, name)
    columns = [c[0] for c in want.description]
    got = se.queries()[name](spark, far).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


def test_numbers_that_fit_stay_as_in_sql(spark):
    reads = spark_fixture(spark, SOURCE, "fx_reads")
    assert dict(reads.dtypes)["rid"] == "bigint"
    assert (WIDE_FROM - 1) * 10**12 + 99 * 10**11 + 10**13 < 2**63
