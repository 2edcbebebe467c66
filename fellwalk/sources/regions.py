"""Region polygons from GeoJSON, brought to longitude and latitude."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fellwalk.functions.projections import TransverseMercator

COLLECTION_SCHEMA = (
    "type string, crs struct<properties:struct<name:string>>, "
    "features array<struct<type:string, geometry:struct<type:string, coordinates:string>>>"
)
POLYGON = "array<array<array<double>>>"
MULTI_POLYGON = "array<array<array<array<double>>>>"

# Names of the longitude / latitude reference system in GeoJSON files.
LONLAT_NAMES = ("urn:ogc:def:crs:OGC:1.3:CRS84", "urn:ogc:def:crs:EPSG::4326", "EPSG:4326", "OGC:CRS84")
UTM_CODE = r"EPSG:+(326|327)(\d\d)$"


def parse_regions(documents: DataFrame, text: str = "value", on_missing_crs: str = "assume") -> DataFrame:
    """Regions of GeoJSON documents, one document per row: ``document``, ``region``, ``rings``.

    ``documents`` has a ``document`` id and the text.  A region is one feature, numbered within its
    document, with its rings as arrays of ``(x, y)`` structs in degrees.  A
    document without a reference system fails (``on_missing_crs="error"``) or is taken as
    longitude and latitude (``"assume"``).  UTM coordinates are converted; other systems fail, and
    so do a document without features and a geometry that is not a polygon.  A feature without a
    geometry is left out.
    """
    if on_missing_crs not in ("error", "assume"):
        raise ValueError("on_missing_crs is 'error' or 'assume'")
    parsed = documents.select("document", F.from_json(text, COLLECTION_SCHEMA).alias("d"))
    empty = F.raise_error(F.concat(F.lit("no geometries in "), F.col("document").cast("string"))).cast(parsed.schema["d"].dataType["features"].dataType)
    listed = F.when(F.size("d.features") > 0, F.col("d.features")).otherwise(empty)
    features = parsed.select("document", F.col("d.crs.properties.name").alias("crs"), F.posexplode(listed).alias("region", "f"))
    shape, coordinates = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    polygons = F.when(shape == "Polygon", F.array(F.from_json(coordinates, POLYGON))).when(
        shape == "MultiPolygon", F.from_json(coordinates, MULTI_POLYGON)
    ).when(shape.isNotNull(), F.raise_error(F.concat(F.lit("not a polygon: "), shape)).cast(MULTI_POLYGON))
    rings = features.select("document", "region", "crs", F.flatten(polygons).alias("rings")).filter(F.col("rings").isNotNull())
    known = rings.withColumn("crs", _checked_crs(F.col("crs"), on_missing_crs))
    degrees = lambda ring: F.transform(ring, lambda p: _to_degrees(p[0], p[1], F.col("crs")))
    return known.select("document", "region", F.transform("rings", degrees).alias("rings"))


def _checked_crs(crs: Column, on_missing_crs: str) -> Column:
    missing = (
        F.lit(LONLAT_NAMES[0]) if on_missing_crs == "assume" else F.raise_error(F.lit("the region file names no reference system"))
    )
    unknown = F.raise_error(F.concat(F.lit("unsupported reference system "), crs))
    known = crs.isin(*LONLAT_NAMES) | crs.rlike(UTM_CODE)
    return F.when(crs.isNull(), missing.cast("string")).when(known, crs).otherwise(unknown.cast("string"))


def _to_degrees(x: Column, y: Column, crs: Column) -> Column:
    zone = F.regexp_extract(crs, UTM_CODE, 2).try_cast("double")
    south = F.regexp_extract(crs, UTM_CODE, 1) == "327"
    utm = TransverseMercator(zone * 6.0 - 183.0, false_northing=F.when(south, 10000000.0).otherwise(0.0))
    lon, lat = utm.inverse(x, y)
    return F.when(crs.isin(*LONLAT_NAMES), F.struct(x.alias("x"), y.alias("y"))).otherwise(F.struct(lon.alias("x"), lat.alias("y")))


def read_regions(spark: SparkSession, path: str, on_missing_crs: str = "assume") -> DataFrame:
    """Regions of GeoJSON files, one whole document per file; files are read in parallel."""
    texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("document"), "value")
    return parse_regions(texts, "value", on_missing_crs)
