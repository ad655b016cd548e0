"""Rounded columns that have to be those of the SQL to the last digit."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from helixframe.functions import stats as St
from helixframe.plans.all import QUERIES, SQL

D = "/root/testdata/sf0.001"


def both(spark, name, d, columns):
    """The sorted rows of a query and of its SQL, unrounded."""
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{d}/lineitem.parquet')")
        want = con.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    got = [tuple(r) for r in QUERIES[name](spark, str(d)).select(*columns).collect()]
    return sorted(got), sorted(want)


@pytest.mark.parametrize("places", [3, 5])
def test_rounded_is_the_round_of_sql(spark, places):
    x = [(2 * k + 1) / (2 * 10**places) for k in range(-2000, 2000)] + [0.128125, 98.514525, -0.0, 1e18, 1.7e308, -1.7e308, math.inf, -math.inf, None, math.nan]
    got = [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(x)], "i int, x double").orderBy("i").select(St.rounded(F.col("x"), places)).collect()]
    with duckdb.connect() as con:
        want = [con.execute(f"SELECT round(?::DOUBLE, {places})", [v]).fetchone()[0] for v in x]
    assert got[:-1] == want[:-1] and math.isnan(got[-1])


def test_likelihood_base_to_the_last_digit(spark):
    got, want = both(spark, "likelihood_base", D, ("record_id", "start", "part", "local_anomaly_z", "is_burn_in", "background_mean_log_prob", "anomaly_depth_ratio"))
    assert got == want


def test_anomaly_layers_to_the_last_digit(spark, tmp_path):
    with duckdb.connect() as con:  # places at halves of the fifth digit: 41/320, 47/640, 63/160, 383/320
        con.execute(
            f"""COPY (SELECT i AS l_orderkey, [41, 47, 63, 383][i % 4 + 1] AS l_partkey, 1 + i % 5 AS l_suppkey, 1 AS l_linenumber, [16.0, 32.0, 8.0, 16.0][i % 4 + 1]::DOUBLE AS l_quantity, 100.0::DOUBLE * (i % 7 + 1) AS l_extendedprice,
            (i % 11) / 100.0::DOUBLE AS l_discount, (i % 9) / 100.0::DOUBLE AS l_tax, CASE WHEN i % 3 = 0 THEN 'R' ELSE 'N' END AS l_returnflag FROM range(120) t(i)) TO '{tmp_path}/lineitem.parquet'"""
        )
    got, want = both(spark, "anomaly_layers", tmp_path, ("record_id", "start", "part", "taxon", "relative_position", "gc_percentile", "length_percentile", "edge_artifact", "taxon_n"))
    assert got == want
