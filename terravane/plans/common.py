"""The driver's tables in the roles the operators expect, in Spark and as SQL with the same arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..sources.tables import table


def points(spark: SparkSession, sf: str) -> DataFrame:
    """events as points of tracks."""
    k = F.col("event_id")
    return table(spark, sf, "events").select(
        F.col("user_id").alias("flight_id"), k.alias("point_id"), "ts", geo.key_lon(k).alias("lon"), geo.key_lat(k).alias("lat"), (500 + (k * 97) % 9000).alias("alt_ft"), ((k * 13) % 200).alias("speed_mph")
    )


POINTS = """pts AS (SELECT user_id AS flight_id, event_id AS point_id, ts, -67.3 + CAST((event_id*37)%1800 AS DOUBLE)/1000.0 AS lon,
 17.9 + CAST((event_id*53)%700 AS DOUBLE)/1000.0 AS lat, 500 + (event_id*97)%9000 AS alt_ft, (event_id*13)%200 AS speed_mph FROM events)"""


def flights(spark: SparkSession, sf: str) -> DataFrame:
    """orders as flights between two of nine airports."""
    k = F.col("o_orderkey")
    code = lambda x: F.element_at(F.array(*(F.lit(a) for a in AIRPORTS)), (x % 9 + 1).cast("int"))
    return table(spark, sf, "orders").select(
        k.alias("flight_id"),
        F.concat(F.lit("N"), F.col("o_custkey").cast("string")).alias("callsign"),
        F.col("o_orderdate").alias("takeoff"),
        F.col("o_orderpriority").alias("mission"),
        F.floor("o_totalprice").cast("long").alias("price"),
        (F.floor("o_totalprice").cast("long") % 480).alias("minutes"),
        code(k).alias("origin"),
        code(F.col("o_custkey")).alias("dest"),
        geo.key_lon(k).alias("origin_lon"),
        geo.key_lat(k).alias("origin_lat"),
        geo.key_lon(F.col("o_custkey")).alias("dest_lon"),
        geo.key_lat(F.col("o_custkey")).alias("dest_lat"),
    )


AIRPORTS = ["SJU", "BQN", "PSE", "SIG", "NRR", "MAZ", "ARE", "CPX", "VQS"]
_CODES = "['SJU','BQN','PSE','SIG','NRR','MAZ','ARE','CPX','VQS']"
FLIGHTS = f"""flights AS (SELECT o_orderkey AS flight_id, 'N' || CAST(o_custkey AS VARCHAR) AS callsign, o_orderdate AS takeoff, o_orderpriority AS mission,
 CAST(floor(o_totalprice) AS BIGINT) AS price, CAST(floor(o_totalprice) AS BIGINT) % 480 AS minutes, {_CODES}[o_orderkey % 9 + 1] AS origin, {_CODES}[o_custkey % 9 + 1] AS dest,
 -67.3 + CAST((o_orderkey*37)%1800 AS DOUBLE)/1000.0 AS origin_lon, 17.9 + CAST((o_orderkey*53)%700 AS DOUBLE)/1000.0 AS origin_lat,
 -67.3 + CAST((o_custkey*37)%1800 AS DOUBLE)/1000.0 AS dest_lon, 17.9 + CAST((o_custkey*53)%700 AS DOUBLE)/1000.0 AS dest_lat FROM orders)"""


def alerts(spark: SparkSession, sf: str) -> DataFrame:
    """events as alerts."""
    sev = F.when(F.col("event_type") == "error", "CRITICAL").when(F.col("event_type") == "purchase", "HIGH").when(F.col("event_type") == "signup", "MEDIUM").when(F.col("event_type") == "click", "LOW").otherwise("INFO")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("alert_id"), F.col("user_id").alias("callsign"), F.col("event_type").alias("category"), sev.alias("severity"), "ts", (F.col("event_id") % 3 == 0).alias("acknowledged"), (F.col("event_id") % 5 == 0).alias("resolved")
    )


ALERTS = """alerts AS (SELECT event_id AS alert_id, user_id AS callsign, event_type AS category, CASE event_type WHEN 'error' THEN 'CRITICAL' WHEN 'purchase' THEN 'HIGH'
 WHEN 'signup' THEN 'MEDIUM' WHEN 'click' THEN 'LOW' ELSE 'INFO' END AS severity, ts, event_id % 3 = 0 AS acknowledged, event_id % 5 = 0 AS resolved FROM events)"""


def sites(spark: SparkSession, sf: str, name: str = "customer") -> DataFrame:
    """customer or supplier as places."""
    p = name[0]
    k = F.col(f"{p}_{'cust' if p == 'c' else 'supp'}key")
    return table(spark, sf, name).select(k.alias("id"), F.col(f"{p}_name").alias("name"), F.col(f"{p}_nationkey").alias("nation"), F.col(f"{p}_acctbal").alias("balance"), geo.key_lon(k).alias("lon"), geo.key_lat(k).alias("lat"))


def site_sql(name: str = "customer", alias: str = "sites") -> str:
    p, k = name[0], ("c_custkey" if name[0] == "c" else "s_suppkey")
    return f"""{alias} AS (SELECT {k} AS id, {p}_name AS name, {p}_nationkey AS nation, {p}_acctbal AS balance, -67.3 + CAST(({k}*37)%1800 AS DOUBLE)/1000.0 AS lon,
 17.9 + CAST(({k}*53)%700 AS DOUBLE)/1000.0 AS lat FROM {name})"""


def hav_sql(lon1: str, lat1: str, lon2: str, lat2: str, radius: float) -> str:
    p, q = f"sin(radians({lat2}-({lat1}))/2)", f"sin(radians({lon2}-({lon1}))/2)"
    return f"(2.0*{radius}*asin(sqrt(least(1.0, {p}*{p}+cos(radians({lat1}))*cos(radians({lat2}))*{q}*{q}))))"


def near_sql(lon: str, lat: str, places) -> str:
    return "least(" + ", ".join(f"sqrt(({lon}-({x}))*({lon}-({x}))+({lat}-({y}))*({lat}-({y})))" for y, x in places) + ")"


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def rounded_half(c: Column, places: int) -> Column:
    """Rounded as the SQL's engine does, after the shift of the point: Spark rounds the shortest decimal that reads as the number, which can lie on the other side of a half."""
    return F.round(c * float(10**places)) / float(10**places)
