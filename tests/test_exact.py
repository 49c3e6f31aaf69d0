"""Results that must not depend on the order of rows or on how an engine rounds."""

from decimal import ROUND_HALF_UP, Decimal
from functools import reduce
from math import floor
from operator import add

from pyspark.sql import functions as F

from terravane.functions import fixed
from terravane.operators import intake, tracks
from terravane.plans import layers


def test_equal_means_tie_by_value(spark):
    rows = [("k", v, c) for v, cs in (("b", (0.1, 0.2, 0.3)), ("a", (0.3, 0.2, 0.1))) for c in cs]
    assert (0.1 + 0.2) + 0.3 > (0.3 + 0.2) + 0.1
    frames = spark.createDataFrame(rows, "callsign string, kind string, confidence double").coalesce(1)
    assert [r["value"] for r in tracks.consensus(frames, ["kind"]).collect()] == ["a"]


def test_points_on_the_edge_have_their_centre_on_it(spark):
    x, y = fixed.REGION[0], fixed.REGION[1]
    n = next(n for n in range(3, 500) if reduce(add, [x] * n) / n < x)
    points = spark.range(n).select(F.col("id").alias("flight_id"), F.lit(x).alias("lon"), F.lit(y).alias("lat"), F.lit(10).alias("speed_mph")).coalesce(1)
    row = intake.places(points).first()
    assert (row["lon"], row["lat"]) == (x, y)
    assert row["nearness"] != "MBIL-X"


def test_ranked_scores_round_as_the_sql(spark, tmp_path):
    import duckdb

    score = lambda d, q, n: 0.5 * d + 0.3 * (q / n) / 100.0 + 0.2 * min(n / 20.0, 1.0)
    every = [(d / 100.0, float(q), n) for d in range(11) for n in range(1, 30) for q in range(n, 50 * n)]
    decimal = lambda x: float(Decimal(repr(x)).quantize(Decimal("0.0001"), ROUND_HALF_UP))
    apart = [g for g in every if decimal(score(*g)) != floor(score(*g) * 1e4 + 0.5) / 1e4][:20]
    assert apart
    lines = [(k, d, 1.0 if i else q - n + 1) for k, (d, q, n) in enumerate(apart) for i in range(n)]
    spark.createDataFrame(lines, "l_suppkey long, l_discount double, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    want = {r[0]: r[1:] for r in con.execute(layers.SQL["ranked_targets"]).fetchall()}
    assert {r["id"]: (r["rank_score"], r["rank"]) for r in layers.ranked_targets(spark, str(tmp_path)).collect()} == want
