"""Layer settings and the ledger of ingested files."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from xml.sax.saxutils import escape

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TYPES = ("image", "elevation", "point", "mapnik")


@dataclass
class Layer:
    name: str
    type: str
    maxlod: int
    extent: list[float]
    srs: str = "EPSG:3857"
    format: str = "png"

    def xml(self) -> str:
        rows = "".join(f"<{k}>{escape(' '.join(map(str, v)) if isinstance(v, list) else str(v))}</{k}>" for k, v in asdict(self).items())
        return f"<LayerSettings>{rows}</LayerSettings>"


LAYER = "name string, type string, maxlod int, extent array<double>, srs string, format string"
LEDGER = "layer string, file string, status string, finished boolean, processing boolean, start timestamp, finish timestamp, lod int, extent array<bigint>"


@dataclass
class Catalog:
    """Layers as a JSON table below a path that all executors see."""

    spark: SparkSession
    path: str

    def exists(self, name: str) -> bool:
        """Whether a layer was stored, by this session or any other."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def create_layer(self, layer: Layer, force: bool = False) -> Layer:
        if layer.type not in TYPES:
            raise ValueError(f"unsupported layer type {layer.type}")
        if self.exists(layer.name) and not force:
            raise ValueError(f"layer {layer.name} exists")
        row = self.spark.createDataFrame([tuple(asdict(layer)[c.split()[0]] for c in LAYER.split(", "))], LAYER)
        row.coalesce(1).write.mode("overwrite").json(f"{self.path}/{layer.name}")
        return layer

    def layers(self) -> DataFrame:
        return self.spark.read.schema(LAYER).json(f"{self.path}/*")


def settings_json() -> Column:
    return F.to_json(F.struct("name", "type", "format", "maxlod", "extent"))


def settings_xml(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", "LayerSettings").load(path)


def pending(files: DataFrame, ledger: DataFrame, keys: list[str]) -> DataFrame:
    """Files to ingest, with their status; what is finished or in progress is left out."""
    done = ledger.where("finished or processing").select(*keys).distinct()
    seen = ledger.select(*keys).distinct().withColumn("_seen", F.lit(True))
    new = files.join(done, keys, "left_anti").join(seen, keys, "left")
    return new.select(*keys, F.when(F.col("_seen"), "reprocessing").otherwise("processing").alias("status"))


def closed(ledger: DataFrame, results: DataFrame, keys: list[str]) -> DataFrame:
    """The ledger after a run. results: keys, ok, extent. A failed file is no longer in
    progress, so that it can be tried again."""
    r = results.select(*keys, "ok", F.col("extent").alias("_extent"))
    out = ledger.join(r, keys, "left")
    told = F.col("ok").isNotNull()
    return out.select(
        *keys,
        F.when(told, F.when(F.col("ok"), "success").otherwise("failed")).otherwise(F.col("status")).alias("status"),
        F.when(told, F.col("ok")).otherwise(F.col("finished")).alias("finished"),
        F.when(told, F.lit(False)).otherwise(F.col("processing")).alias("processing"),
        F.coalesce("_extent", "extent").alias("extent"),
    )
