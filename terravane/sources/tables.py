"""Readers, each with a fixed schema where the format does not carry one, and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """df, computed once into spark.checkpoint.dir; where none is set, a folder of this machine, and an error on a cluster."""
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="terravane-checkpoint-"))
    return df.checkpoint(eager=True)


def table_or_empty(spark: SparkSession, name: str, schema: str) -> DataFrame:
    """A table of the catalog, or no rows of the schema if there is none."""
    return spark.table(name) if spark.catalog.tableExists(name) else spark.createDataFrame([], schema)


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """df, or an error that names every missing column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object for each line; malformed lines are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def json_line_counts(spark: SparkSession, path: str) -> DataFrame:
    """n_valid and n_invalid lines of a JSON-lines file; empty lines don't count."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    good = F.expr("try_parse_json(value)").isNotNull()
    return lines.agg(F.count_if(good).alias("n_valid"), F.count_if(~good).alias("n_invalid"))


def delimited(spark: SparkSession, path: str, schema: str, sep: str = ",", strict: bool = True) -> DataFrame:
    """A file with a header line and typed columns; in strict mode a bad value is an error."""
    return spark.read.schema(schema).option("header", True).option("sep", sep).option("mode", "FAILFAST" if strict else "PERMISSIVE").csv(path)


COLLECTION = "type string, features array<struct<id: string, geometry: struct<type: string, coordinates: string>, properties: map<string, string>>>"


def features(spark: SparkSession, path: str) -> DataFrame:
    """The features of GeoJSON collections: ord, id, geometry type, coordinates as JSON text, properties.

    A file that is no FeatureCollection is an error.
    """
    docs = spark.read.schema(COLLECTION).option("multiLine", True).json(path)
    sure = docs.where(F.assert_true(F.col("type") == "FeatureCollection", F.lit("not a FeatureCollection")).isNull())
    each = sure.select(F.posexplode("features").alias("ord", "f"))
    return each.select("ord", "f.id", F.col("f.geometry.type").alias("geometry_type"), F.col("f.geometry.coordinates").alias("coordinates"), F.col("f.properties").alias("properties"))


def point_features(found: DataFrame) -> DataFrame:
    """Features with lon and lat from Point geometries; other geometries have nulls and stay."""
    xy = F.from_json("coordinates", "array<double>")
    point = F.col("geometry_type") == "Point"
    return found.withColumns({"lon": F.when(point, F.get(xy, 0)), "lat": F.when(point, F.get(xy, 1))})


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """path, length and SHA-256 of every file below a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def verify_files(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """Files of a manifest (name, sha256) and of a folder against each other: name and state.

    States are ok, changed, missing and unlisted.
    """
    have = file_hashes(spark, path).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("sha256").alias("have"))
    both = manifest.select("name", F.col("sha256").alias("want")).join(have, "name", "full_outer")
    state = F.when(F.col("have").isNull(), "missing").when(F.col("want").isNull(), "unlisted").when(F.col("have") == F.col("want"), "ok").otherwise("changed")
    return both.select("name", state.alias("state"))


def not_done(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The rows whose key an earlier run has not written; how a job resumes."""
    return rows.join(done.select(key).distinct(), key, "left_anti")
