"""GeoJSON and JSON-record output, one JSON text per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placetide.functions.geo import geojson_geometry
from placetide.operators.scale import require_metric
from placetide.sources.storage import stored

_KEEP_NULLS = {"ignoreNullFields": "false"}
_NOT_PROPERTIES = {"geometry_wkt", "norm", "scale_min", "scale_max"}


def feature(layer: DataFrame, geometry: str = "geometry_wkt", with_geometry: bool = True) -> Column:
    """One GeoJSON feature: geometry (or null) and all other columns, NULL kept as null."""
    names = [c for c in layer.columns if c not in _NOT_PROPERTIES | {geometry}]
    properties = F.to_json(F.struct(*names), _KEEP_NULLS)
    shape = geojson_geometry(geometry) if with_geometry else F.lit("null")
    return F.concat(
        F.lit('{"type":"Feature","geometry":'), shape, F.lit(',"properties":'), properties, F.lit("}")
    )


def features(layer: DataFrame, geometry: str = "geometry_wkt", with_geometry: bool = True) -> DataFrame:
    return layer.select(feature(layer, geometry, with_geometry).alias("feature"))


def layer_meta(layer: DataFrame, metric: str) -> DataFrame:
    """One row: the ``meta`` block of a coloured layer (no row for an empty layer)."""
    m = require_metric(metric)
    bounds = layer.agg(F.max("scale_min").alias("min"), F.max("scale_max").alias("max"), F.count("*").alias("_n"))
    block = F.struct(
        "min",
        "max",
        F.lit(metric).alias("metric"),
        F.lit(m["label"]).alias("label"),
        F.lit(m["format"]).alias("format"),
        F.lit(m["description"]).alias("description"),
    )
    return bounds.filter("_n > 0").select(F.to_json(block, _KEEP_NULLS).alias("meta"))


def write_features(layer: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Newline-delimited features, written by all tasks; the form for a layer of any size."""
    features(layer).write.mode(mode).text(path)


def feature_collection(layer: DataFrame, metric: str, max_features: int = 100_000) -> str:
    """One FeatureCollection document on the driver, for a layer a browser can hold.

    A larger layer is refused rather than cut; use :func:`write_features` for it.
    """
    rows = features(layer).limit(max_features + 1).collect()
    if len(rows) > max_features:
        raise ValueError(f"layer has more than {max_features} features; write it as lines")
    meta = layer_meta(layer, metric).first()
    body = ",".join(r["feature"] for r in rows)
    return f'{{"type":"FeatureCollection","features":[{body}],"meta":{meta["meta"] if meta else "null"}}}'


def _write_document(lines: DataFrame, head: str, foot: DataFrame, path: str, mode: str) -> None:
    """One JSON document as part files, to be put together in the order of their names.

    ``lines`` has the columns ``line`` and ``place``, by which its rows are ordered; ``foot`` is a
    row ``line`` that ends the document. The rows are stored first: a row's place in a file then tells equal ones
    apart, so exactly one has no comma before it, whichever task writes it.
    """
    spark = lines.sparkSession
    held = stored(lines, "document").select("line", F.struct("place", "_metadata.file_path", "_metadata.row_index").alias("at"))
    first = held.agg(F.min("at").alias("at")).scalar()
    body = held.select(F.lit(1).alias("part"), "at", F.concat(F.when(F.col("at") == first, "").otherwise(","), "line").alias("value"))
    nowhere = F.lit(None).cast(held.schema["at"].dataType)
    ends = [(0, spark.range(1).select(F.lit(head).alias("line"))), (2, foot)]
    for part, end in ends:
        body = body.unionByName(end.select(F.lit(part).alias("part"), nowhere.alias("at"), F.col("line").alias("value")))
    body.orderBy("part", "at").select("value").write.mode(mode).text(path)


def write_collection(
    layer: DataFrame, metric: str, path: str, order_by: Sequence[str] = ("geography_id",), mode: str = "errorifexists"
) -> None:
    """One FeatureCollection document of any number of features, written by all tasks.

    The part files under ``path``, one after the other by name, are the document; features stand
    in the order of ``order_by``. Nothing is collected. An empty layer has ``null`` as its meta block.
    """
    lines = layer.select(feature(layer).alias("line"), F.struct(*order_by).alias("place"))
    # The aggregate keeps the row of an empty layer, too.
    meta = layer_meta(layer, metric).agg(F.coalesce(F.max("meta"), F.lit("null")).alias("meta"))
    foot = meta.select(F.concat(F.lit('],"meta":'), "meta", F.lit("}")).alias("line"))
    _write_document(lines, '{"type":"FeatureCollection","features":[', foot, path, mode)


def write_flow_document(
    flows: DataFrame,
    path: str,
    order_by: Sequence[str] = ("origin_geography_id", "dest_geography_id"),
    mode: str = "errorifexists",
) -> None:
    """``{"flows":[...]}`` of any number of flows, as :func:`write_collection` does."""
    line = F.to_json(F.struct(*flows.columns), _KEEP_NULLS).alias("line")
    foot = flows.sparkSession.range(1).select(F.lit("]}").alias("line"))
    _write_document(flows.select(line, F.struct(*order_by).alias("place")), '{"flows":[', foot, path, mode)


def records(df: DataFrame) -> DataFrame:
    """Rows as JSON texts with NULLs kept."""
    return df.select(F.to_json(F.struct(*df.columns), _KEEP_NULLS).alias("record"))


def flow_document(flows: DataFrame, max_rows: int = 100_000) -> str:
    """``{"flows":[...]}`` of a bounded flow list; a longer one is refused."""
    rows = records(flows).limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} flows; write them as lines")
    return '{"flows":[' + ",".join(r["record"] for r in rows) + "]}"
