"""Model versions and aliases, kept as small parquet tables beside the saved models."""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripsense.sources.commits import names_in, put_if_absent

CHAMPION = "champion"

_VERSIONS = "name string, version string, run_id string, path string, metadata string"
_ALIASES = "name string, alias string, version string, sequence long"


def resolve_version(entries: DataFrame, alias: str = CHAMPION) -> DataFrame:
    """Per model name the version that carries ``alias``, else the highest version number."""
    carries = F.coalesce(F.col("alias") == alias, F.lit(False))
    best = F.max(F.struct(carries.alias("_carries"), F.col("version").cast("long").alias("_number"), "version", "run_id"))
    return entries.groupBy("name").agg(best.alias("_best")).select("name", "_best.version", "_best.run_id")


@dataclass(frozen=True)
class LoadedModel:
    name: str
    version: str
    model: PipelineModel
    metadata: dict

    def __call__(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)


class ModelRegistry:
    """Version numbers and the order of aliases are claimed by files that only one writer can put in place."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _table(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], schema)
            raise

    def _append(self, name: str, schema: str, row: tuple) -> None:
        self.spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(f"{self.root}/{name}")

    def _claim(self, what: str, least: int) -> int:
        """The next free number of a kind, for this writer alone."""
        folder = f"{self.root}/claims/{what}"
        taken = [int(name) for name in names_in(self.spark, folder) if name.isdigit()]
        number = max([least, *(n + 1 for n in taken)])
        while not put_if_absent(self.spark, folder, str(number), ""):
            number += 1
        return number

    def entries(self) -> DataFrame:
        """``name, version, run_id, alias``; an alias belongs to the version it was last given to."""
        current = (
            self._table("aliases", _ALIASES)
            .groupBy("name", "alias")
            .agg(F.max_by("version", "sequence").alias("version"))
        )
        versions = self._table("versions", _VERSIONS).select("name", "version", "run_id")
        return versions.join(current, ["name", "version"], "left").select("name", "version", "run_id", "alias")

    def register(self, name: str, model: PipelineModel, metadata: dict, *, alias: str | None = None) -> str:
        run_id = uuid.uuid4().hex
        path = f"{self.root}/models/{run_id}"
        model.write().save(path)
        known = self._table("versions", _VERSIONS).filter(F.col("name") == name)
        version = str(self._claim(f"versions/{name}", (known.agg(F.max(F.col("version").cast("long"))).first()[0] or 0) + 1))
        self._append("versions", _VERSIONS, (name, version, run_id, path, json.dumps(metadata)))
        if alias:
            self.set_alias(name, version, alias)
        return version

    def set_alias(self, name: str, version: str, alias: str = CHAMPION) -> None:
        assigned = self._table("aliases", _ALIASES).agg(F.max("sequence")).first()[0] or 0
        self._append("aliases", _ALIASES, (name, alias, version, self._claim("aliases", assigned + 1)))

    def resolve(self, name: str, alias: str = CHAMPION) -> str:
        found = resolve_version(self.entries().filter(F.col("name") == name), alias).first()
        if found is None:
            raise LookupError(f"no versions found for model {name!r}")
        return found["version"]

    def load(self, name: str, version: str | None = None) -> LoadedModel:
        version = version or self.resolve(name)
        stored = self._table("versions", _VERSIONS).filter((F.col("name") == name) & (F.col("version") == version)).first()
        if stored is None:
            raise LookupError(f"model {name!r} has no version {version}")
        return LoadedModel(name, version, PipelineModel.load(stored["path"]), json.loads(stored["metadata"]))


class ModelFollower:
    """Scores with the version currently served.

    The registry is asked again at the first batch after ``check_seconds``; a model is loaded only when another
    version is to be served. A batch is scored by one version, which stands in ``model_version``.
    """

    def __init__(self, registry: ModelRegistry, name: str, *, check_seconds: float = 10.0):
        self.registry = registry
        self.name = name
        self.check_seconds = check_seconds
        self.current: LoadedModel | None = None
        self._checked = float("-inf")

    def serve(self, name: str) -> None:
        """Switch to another model name, from the next batch on."""
        self.name = name
        self._checked = float("-inf")

    def __call__(self, df: DataFrame) -> DataFrame:
        if time.monotonic() - self._checked >= self.check_seconds:
            version = self.registry.resolve(self.name)
            if self.current is None or (self.current.name, self.current.version) != (self.name, version):
                self.current = self.registry.load(self.name, version)
            self._checked = time.monotonic()
        return self.current(df).withColumn("model_version", F.lit(self.current.version))
