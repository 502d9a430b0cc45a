"""Model registry as tables: one row per version and an append-only alias history; the newest row of an alias wins."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgrid.config import Project
from flowgrid.operators.models import Fitted
from flowgrid.sources import tables as T

VERSIONS = ("version int, family string, path string, lag string, default double, series_keys array<string>, "
            "parts array<string>, tags map<string,string>, created_at timestamp")
ALIASES = "alias string, version int, seq int, created_at timestamp"


class Registry:
    """Versions, tags and the champion / challenger aliases of one model name."""

    def __init__(self, spark: SparkSession, p: Project):
        self.spark, self.root = spark, f"{p.root}/ml/{p.model_name}"

    def _table(self, name: str, ddl: str) -> DataFrame:
        path = f"{self.root}/{name}"
        return self.spark.read.schema(ddl).parquet(path) if T.exists(self.spark, path) else self.spark.createDataFrame([], ddl)

    def _next(self, name: str, ddl: str, column: str) -> int:
        return 1 + (self._table(name, ddl).agg(F.max(column)).first()[0] or 0)

    def _add(self, name: str, ddl: str, row: dict) -> None:
        one = self.spark.createDataFrame([{**row, "created_at": None}], ddl)
        T.append(one.withColumn("created_at", F.current_timestamp()), f"{self.root}/{name}")

    def register(self, model: Fitted, tags: dict[str, str]) -> int:
        """Save a fitted family and return its new version number."""
        version = self._next("versions", VERSIONS, "version")
        path = f"{self.root}/models/{version}"
        for name, part in model.parts.items():
            part.write().overwrite().save(f"{path}/{name}")
        if model.trend is not None:
            T.overwrite(model.trend, f"{path}/trend")
        self._add("versions", VERSIONS, {
            "version": version, "family": model.family, "path": path, "lag": model.lag, "default": model.default,
            "series_keys": list(model.keys), "parts": list(model.parts), "tags": {**tags, "family": model.family}})
        return version

    def set_alias(self, alias: str, version: int) -> None:
        seq = self._next("aliases", ALIASES, "seq")
        self._add("aliases", ALIASES, {"alias": alias, "version": version, "seq": seq})

    def version(self, alias: str) -> dict | None:
        """The version an alias points to, or None."""
        number = self._table("aliases", ALIASES).where(F.col("alias") == alias).agg(F.max_by("version", "seq")).first()[0]
        if number is None:
            return None
        return self._table("versions", VERSIONS).where(F.col("version") == number).first().asDict()

    def load(self, alias: str) -> tuple[Fitted | None, dict | None]:
        v = self.version(alias)
        if v is None:
            return None, None
        parts = {n: PipelineModel.load(f"{v['path']}/{n}") for n in v["parts"]}
        trend_path = f"{v['path']}/trend"
        trend = self.spark.read.parquet(trend_path) if T.exists(self.spark, trend_path) else None
        return Fitted(v["family"], v["series_keys"], parts, trend, v["default"], v["lag"]), v
