"""Small helpers that several text operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six white-space bytes between words, as a regular expression class and as characters.
SPACE = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\f\r"


def _own_folder(spark: SparkSession) -> None:
    """A temporary checkpoint folder, for a session on one machine only; a cluster has to name a shared one."""
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="terravane-checkpoint-"))


def saved(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the cluster's shared checkpoint folder.

    The folder is the session's spark.checkpoint.dir. Only where none is set, as in tests on one machine, a
    temporary folder is used.
    """
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None:
        _own_folder(spark)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where
    if spark.sparkContext.getCheckpointDir() is None:
        _own_folder(spark)
    return spark.sparkContext.getCheckpointDir()


def numbered(df: DataFrame, name: str) -> DataFrame:
    """df with a number for each row in the column name, written to the shared folder, so that every pass sees the same numbers."""
    at = f"{shared_folder(df.sparkSession)}/numbered-{uuid.uuid4().hex}"
    rows = df.withColumn(name, F.monotonically_increasing_id())
    rows.write.option("compression", "zstd").parquet(at)
    return df.sparkSession.read.schema(rows.schema).parquet(at)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once for each row however often body names it."""
    return F.transform(F.array(value), body)[0]


def whole_text(column: str = "text") -> Column:
    """The text, a null one as the empty string."""
    return F.coalesce(F.col(column), F.lit(""))


def word_list(text: Column) -> Column:
    """The words of a text: runs of characters other than SPACE."""
    inner = F.trim(text, F.lit(SPACE_CHARS))
    return let(inner, lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE + "+")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
