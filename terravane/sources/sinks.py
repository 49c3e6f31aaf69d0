"""Sinks: delimited text, JSON lines, GeoJSON, KML placemarks, and packages with a manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import file_hashes


def feature_json(properties: list[str], lon: str = "lon", lat: str = "lat") -> Column:
    """A GeoJSON point feature as text; the geometry is null where there is no place."""
    point = F.when(F.col(lon).isNotNull() & F.col(lat).isNotNull(), F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), point.alias("geometry"), F.struct(*sorted(properties)).alias("properties")), {"ignoreNullFields": "false"})


def line_json(properties: list[str], points: str = "points") -> Column:
    """A GeoJSON line feature from an array of structs (lon, lat)."""
    line = F.struct(F.lit("LineString").alias("type"), F.transform(points, lambda p: F.array(p["lon"], p["lat"])).alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), line.alias("geometry"), F.struct(*sorted(properties)).alias("properties")), {"ignoreNullFields": "false"})


def placemark(name: str, lon: str = "lon", lat: str = "lat") -> Column:
    """A KML placemark with escaped text."""
    safe = F.coalesce(F.col(name).cast("string"), F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        safe = F.replace(safe, F.lit(a), F.lit(b))
    return F.format_string("<Placemark><name>%s</name><Point><coordinates>%s,%s,0</coordinates></Point></Placemark>", safe, F.col(lon).cast("string"), F.col(lat).cast("string"))


def write_json_lines(df: DataFrame, path: str) -> None:
    """One object for each row, keys in alphabetical order."""
    df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("value")).write.text(path)


def write_delimited(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Files with header lines; with an order they are range-partitioned, so reading them by name gives sorted rows."""
    out = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    out.write.option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)


def write_package(streams: dict[str, DataFrame], path: str) -> DataFrame:
    """Every stream as JSON lines below path, and the manifest: file name, bytes and SHA-256, written as JSON too."""
    for name, df in streams.items():
        write_json_lines(df, f"{path}/{name}")
    spark = next(iter(streams.values())).sparkSession
    files = file_hashes(spark, path).where(F.col("path").rlike("/part-[^/]*$"))
    manifest = files.select(F.element_at(F.split("path", "/"), -2).alias("stream"), F.element_at(F.split("path", "/"), -1).alias("name"), "length", "sha256")
    manifest.write.json(f"{path}/manifest")
    return spark.read.schema("stream string, name string, length long, sha256 string").json(f"{path}/manifest")
