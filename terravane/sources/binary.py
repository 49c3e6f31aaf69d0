"""Readers of binary layers: files arrive as rows of binaryFile, and each is decoded inside the task that holds it.

One file is one task's work, as these formats have no split points; a layer of many files spreads over the cluster. The
decoders yield rows in small batches, so a file costs its bytes and no more. A file that breaks its format is an error
that names it.
"""

from __future__ import annotations

import io
import json
import struct
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

BATCH = 10_000


def _files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).select("path", "content")


def _batches(rows: Iterator[tuple], names: list[str]) -> Iterator[pd.DataFrame]:
    held: list[tuple] = []
    for r in rows:
        held.append(r)
        if len(held) == BATCH:
            yield pd.DataFrame(held, columns=names)
            held = []
    if held:
        yield pd.DataFrame(held, columns=names)


def dbf_records(data: bytes) -> Iterator[dict[str, str]]:
    """Fields of each record that isn't deleted, as trimmed text."""
    if len(data) < 33:
        raise ValueError("the header is cut short")
    n, start, width = struct.unpack_from("<IHH", data, 4)
    fields: list[tuple[str, int]] = []
    for p in range(32, min(start, len(data)) - 31, 32):
        if data[p] == 13:
            break
        fields.append((data[p : p + 11].split(b"\0")[0].decode("ascii").strip(), data[p + 16]))
    if not fields or any(not name or not size for name, size in fields):
        raise ValueError("no fields, or one without name or width")
    if start + n * width > len(data):
        raise ValueError("records are cut short")
    for k in range(n):
        at = start + k * width
        if data[at] == ord("*"):
            yield {}
            continue
        at += 1
        row = {}
        for name, size in fields:
            row[name] = data[at : at + size].decode("latin-1").strip()
            at += size
        yield row


def dbf(spark: SparkSession, path: str) -> DataFrame:
    """path, record (its place in the file) and fields (a map of texts) of all dBase tables below a folder."""

    def decode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for name, data in zip(part["path"], part["content"], strict=True):
                try:
                    yield from _batches(((name, i, r) for i, r in enumerate(dbf_records(data)) if r), ["path", "record", "fields"])
                except ValueError as e:
                    raise ValueError(f"{name}: {e}") from e

    return _files(spark, path, "*.dbf").mapInPandas(decode, "path string, record long, fields map<string,string>")


def shapes(data: bytes) -> Iterator[tuple[str | None, list]]:
    """Kind and parts (lists of points) of every shape of a .shp file; measures and heights are left out."""
    kinds = {1: "Point", 3: "LineString", 5: "Polygon", 8: "MultiPoint"}
    if len(data) < 100 or struct.unpack_from(">I", data)[0] != 9994:
        raise ValueError("no shapefile header")
    at = 100
    while at + 8 <= len(data):
        size = struct.unpack_from(">I", data, at + 4)[0] * 2
        body = data[at + 8 : at + 8 + size]
        at += 8 + size
        if len(body) < size or size < 4:
            raise ValueError("a record is cut short")
        code = struct.unpack_from("<I", body)[0]
        kind = kinds.get(code % 10) if code else None
        if kind is None:
            yield None, []
        elif kind == "Point":
            yield kind, [[struct.unpack_from("<2d", body, 4)]]
        elif kind == "MultiPoint":
            n = struct.unpack_from("<I", body, 36)[0]
            yield kind, [list(struct.iter_unpack("<2d", body[40 : 40 + 16 * n]))]
        else:
            n_parts, n = struct.unpack_from("<2I", body, 36)
            first = struct.unpack_from(f"<{n_parts}I", body, 44)
            base = 44 + 4 * n_parts
            pts = list(struct.iter_unpack("<2d", body[base : base + 16 * n]))
            yield kind, [pts[a:b] for a, b in zip(first, (*first[1:], n), strict=True)]


def zipped_shapes(spark: SparkSession, path: str) -> DataFrame:
    """Features of zipped shapefiles: path, record, kind, parts and fields. An archive holds one .shp and one .dbf."""

    def rows(name: str, data: bytes) -> Iterator[tuple]:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            one = {}
            for end in (".shp", ".dbf"):
                found = [m for m in z.namelist() if m.lower().endswith(end)]
                if len(found) != 1:
                    raise ValueError(f"{len(found)} members end in {end}")
                one[end] = z.read(found[0])
        for i, ((kind, parts), fields) in enumerate(zip(shapes(one[".shp"]), dbf_records(one[".dbf"]), strict=True)):
            if fields:
                yield name, i, kind, [[list(p) for p in part] for part in parts], fields

    def decode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for name, data in zip(part["path"], part["content"], strict=True):
                try:
                    yield from _batches(rows(name, data), ["path", "record", "kind", "parts", "fields"])
                except (ValueError, zipfile.BadZipFile) as e:
                    raise ValueError(f"{name}: {e}") from e

    return _files(spark, path, "*.zip").mapInPandas(decode, "path string, record long, kind string, parts array<array<array<double>>>, fields map<string,string>")


def _wkb(data: bytes, at: int) -> tuple[str | None, list]:
    """Kind and coordinates of a geometry, in two dimensions; of a collection, its first member."""
    order = "<" if data[at] == 1 else ">"
    code = struct.unpack_from(order + "I", data, at + 1)[0]
    # Heights and measures are told by thousands or by high bits, according to the writer.
    extra = ((code >> 31) & 1) + ((code >> 30) & 1) or {0: 0, 1: 1, 2: 1, 3: 2}.get((code & 0xFFFFFFF) // 1000, 0)
    kind, step, at = (code & 0xFFFFFFF) % 1000, 8 * (2 + extra), at + 5

    def count(p: int) -> int:
        return struct.unpack_from(order + "I", data, p)[0]

    def run(p: int, n: int) -> list:
        return [list(struct.unpack_from(order + "2d", data, p + i * step)) for i in range(n)]

    if kind == 1:
        return "Point", run(at, 1)[0]
    if kind == 2:
        return "LineString", run(at + 4, count(at))
    if kind == 3:
        rings, p = [], at + 4
        for _ in range(count(at)):
            rings.append(run(p + 4, count(p)))
            p += 4 + len(rings[-1]) * step
        return "Polygon", rings
    if kind in (4, 5, 6, 7) and count(at):
        return _wkb(data, at + 4)
    return None, []


@F.pandas_udf(StructType([StructField("kind", StringType()), StructField("lon", DoubleType()), StructField("lat", DoubleType()), StructField("coordinates", StringType())]))
def _package_geometry(blobs: pd.Series) -> pd.DataFrame:
    envelope = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}
    out = []
    for b in blobs:
        row: tuple = (None, None, None, None)
        if b is not None and len(b) >= 8 and bytes(b[:2]) == b"GP":
            try:
                kind, xy = _wkb(bytes(b), 8 + envelope.get((b[3] >> 1) & 7, 0))
                if kind:
                    line = xy if kind == "LineString" else xy[0] if kind == "Polygon" else [xy]
                    x, y = line[len(line) // 2] if kind == "LineString" else (sum(c) / len(line) for c in zip(*line, strict=True))
                    row = (kind, x, y, json.dumps(xy))
            except (struct.error, IndexError, ValueError):
                pass
        out.append(row)
    return pd.DataFrame(out, columns=["kind", "lon", "lat", "coordinates"])


def package_geometry(blob: Column | str) -> Column:
    """kind, lon, lat and coordinates (JSON) of a GeoPackage geometry; all null where it can't be read.

    The anchor is the point, a line's middle vertex, or the mean of an outer ring's vertices.
    """
    return _package_geometry(blob)


def package_rows(spark: SparkSession, path: str, table: str) -> DataFrame:
    """path, rowid, fields (a map of texts) and geometry (bytes) of a table in the GeoPackages below a folder.

    The first blob of a row is its geometry. SQLite reads the bytes where they are, without a file of its own.
    """
    quoted = '"' + table.replace('"', '""') + '"'

    def rows(name: str, data: bytes) -> Iterator[tuple]:
        import sqlite3

        con = sqlite3.connect(":memory:")
        try:
            con.deserialize(data)
            cur = con.execute(f"SELECT rowid, * FROM {quoted} ORDER BY rowid")
            names = [d[0] for d in cur.description][1:]
            for rowid, *values in cur:
                blob = next((v for v in values if isinstance(v, bytes)), None)
                yield name, rowid, {k: str(v) for k, v in zip(names, values, strict=True) if v is not None and not isinstance(v, bytes)}, blob
        finally:
            con.close()

    def decode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for name, data in zip(part["path"], part["content"], strict=True):
                yield from _batches(rows(name, bytes(data)), ["path", "rowid", "fields", "geometry"])

    return _files(spark, path, "*.gpkg").mapInPandas(decode, "path string, rowid long, fields map<string,string>, geometry binary")


def placemarks(spark: SparkSession, path: str) -> DataFrame:
    """name, kind and coordinates text of the placemarks of KML files below a folder."""
    schema = "name string, Point struct<coordinates: string>, LineString struct<coordinates: string>, Polygon struct<outerBoundaryIs: struct<LinearRing: struct<coordinates: string>>>"
    marks = spark.read.schema(schema).option("rowTag", "Placemark").option("recursiveFileLookup", True).option("pathGlobFilter", "*.kml").format("xml").load(path)
    ring = F.col("Polygon.outerBoundaryIs.LinearRing.coordinates")
    kind = F.when(F.col("Point").isNotNull(), "Point").when(F.col("LineString").isNotNull(), "LineString").when(ring.isNotNull(), "Polygon")
    text = F.trim(F.coalesce("Point.coordinates", "LineString.coordinates", ring))
    pairs = F.transform(F.split(text, r"\s+"), lambda t: F.transform(F.slice(F.split(t, ","), 1, 2), lambda v: v.cast("double")))
    return marks.select("name", kind.alias("kind"), pairs.alias("points"))


def element_values(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """The distinct texts of an element in the GML or XML files below a folder, whatever its prefix."""
    texts = spark.read.option("recursiveFileLookup", True).option("wholetext", True).text(path)
    found = F.regexp_extract_all("value", F.lit(rf"<(?:\w+:)?{tag}(?:\s[^>]*)?>\s*([^<]*?)\s*</(?:\w+:)?{tag}>"), F.lit(1))
    return texts.select(F.explode(found).alias("value")).where("value <> ''").distinct()
