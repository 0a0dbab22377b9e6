"""A registry of trained models: artifacts per version, and append-only deployment events.

``versions/<version>/chain`` holds the fitted stages, ``encoder`` the fitted encoder and
``metadata`` one JSON line. Deployments and deletions are rows in tables of events, the last of
which counts, so no file is ever changed in place.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import UnknownVersionError
from tidemark.operators.attribution import LeafTable, read_leaf_table
from tidemark.operators.encoding import FittedEncoder
from tidemark.operators.training import AttritionModel
from tidemark.sources.storage import any_match, empty, exists, replace_text

METADATA_SCHEMA = T.StructType(
    [
        T.StructField("version", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("n_features", T.IntegerType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField(
            "features",
            T.StructType(
                [
                    T.StructField("numerical", T.ArrayType(T.StringType())),
                    T.StructField("categorical", T.ArrayType(T.StringType())),
                ]
            ),
        ),
        T.StructField("description", T.StringType()),
        T.StructField("monthly_median", T.DoubleType()),
        T.StructField("document", T.StringType()),  # the whole object as JSON, with keys beyond these
    ]
)
EVENT_SCHEMA = "version string, event string, at timestamp"
_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def version_name(at: Column) -> Column:
    return F.concat(F.lit("v_"), F.date_format(at, "yyyyMMdd_HHmmss"))


def scan_metadata(spark: SparkSession, pattern: str) -> DataFrame:
    """Version metadata from one JSON file per version folder, with defaults for absent fields.

    Folders whose name starts with a dot and files that are not JSON are skipped; a version
    without a name takes that of its folder.
    """
    if not any_match(spark, pattern):
        return empty(spark, METADATA_SCHEMA)
    known = T.StructType(METADATA_SCHEMA.fields[:-1])
    corrupt = T.StructType([*known.fields, T.StructField("_broken", T.StringType())])
    parsed = F.from_json("value", corrupt, {"columnNameOfCorruptRecord": "_broken"})
    rows = (
        spark.read.option("wholetext", True)
        .text(pattern)
        .withColumn("__folder", F.regexp_extract(F.input_file_name(), r"/([^/]+)/metadata(\.json)?(/[^/]*)?$", 1))
        .where(F.length(F.trim("value")) > 0)
        .select(parsed.alias("m"), F.trim("value").alias("document"), "__folder")
        .select("m.*", "document", "__folder")
    )
    return (
        rows.where(F.col("_broken").isNull() & ~F.col("__folder").startswith("."))
        .withColumns(
            {
                "version": F.coalesce("version", "__folder"),
                "timestamp": F.coalesce("timestamp", F.lit("")),
                "n_features": F.coalesce("n_features", F.lit(0)),
                "params": F.coalesce("params", F.create_map().cast("map<string,string>")),
                "metrics": F.coalesce("metrics", F.create_map().cast("map<string,double>")),
            }
        )
        .select(*METADATA_SCHEMA.names)
    )


def latest_version(metadata: DataFrame) -> DataFrame:
    """One row with the newest version."""
    return metadata.agg(F.max_by("version", F.struct("timestamp", "version")).alias("version"))


def last_events(events: DataFrame, kind: str) -> DataFrame:
    """The newest time of each version's events of one kind."""
    return events.where(F.col("event") == kind).groupBy("version").agg(F.max("at").alias("at"))


def live_versions(metadata: DataFrame, events: DataFrame) -> DataFrame:
    """Versions that were not deleted after they were last saved."""
    gone = last_events(events, "delete").select("version", F.col("at").alias("__gone"))
    saved = F.to_timestamp("timestamp")
    return (
        metadata.join(gone, "version", "left")
        .where(F.col("__gone").isNull() | (saved > F.col("__gone")))
        .drop("__gone")
        .select(*metadata.columns)
    )


def deployed_version(events: DataFrame) -> DataFrame:
    """One row with the version deployed last; NULL if none ever was."""
    return events.where(F.col("event") == "deploy").agg(
        F.max_by("version", F.struct("at", "version")).alias("version")
    )


def serving_version(metadata: DataFrame, events: DataFrame) -> DataFrame:
    """One row: the deployed version, or the latest one where none is deployed."""
    return latest_version(metadata).select(
        F.coalesce(deployed_version(events).scalar(), F.col("version")).alias("version")
    )


def version_comparison(metadata: DataFrame) -> DataFrame:
    """Recall, precision and F1 of every version, newest first."""
    return metadata.select(
        "version",
        "timestamp",
        F.col("metrics")["recall"].alias("recall"),
        F.col("metrics")["precision"].alias("precision"),
        F.col("metrics")["f1_score"].alias("f1_score"),
    ).orderBy(F.desc("timestamp"), "version")


class ModelRegistry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.events_path = f"{self.root}/events"

    def _folder(self, version: str) -> str:
        return f"{self.root}/versions/{version}"

    def save(self, model: AttritionModel, version: str | None = None, metadata: Mapping[str, Any] | None = None) -> str:
        """Save a model; the caller's metadata wins over the derived fields."""
        now = self.spark.range(1).select(
            version_name(F.current_timestamp()).alias("name"), F.date_format(F.current_timestamp(), _ISO).alias("at")
        ).first()
        version = version or now.name
        # files of their own for every save; the metadata, which comes last and in one step, names them
        files = f"files-{uuid.uuid4().hex}"
        folder = f"{self._folder(version)}/{files}"
        model.chain.write().save(f"{folder}/chain")
        model.encoder.save(self.spark, f"{folder}/encoder")
        merged = {
            "version": version,
            "timestamp": now["at"],
            "n_features": len(model.feature_names),
            "params": {k: str(v) for k, v in model.params.items()},
            "features": {"numerical": list(model.encoder.means), "categorical": list(model.encoder.modes)},
            "monthly_median": model.monthly_median,
            **(metadata or {}),
            "files": files,
        }
        replace_text(self.spark, f"{self._folder(version)}/metadata/metadata.json", json.dumps(merged, default=str) + "\n")
        return version

    def _files(self, version: str) -> str:
        """The folder with the parts of a live version."""
        folder = f"{self._folder(version)}/{self.metadata(version)['files']}"
        for part in ("chain", "encoder"):
            if not exists(self.spark, f"{folder}/{part}"):
                raise FileNotFoundError(f"Version '{version}' lacks its {part}")
        return folder

    def versions(self) -> DataFrame:
        """Metadata of the live versions, newest first."""
        return live_versions(self._all_metadata(), self.events()).orderBy(F.desc("timestamp"), "version")

    def _all_metadata(self) -> DataFrame:
        return scan_metadata(self.spark, f"{self.root}/versions/*/metadata")

    def events(self) -> DataFrame:
        if not exists(self.spark, self.events_path):
            return empty(self.spark, EVENT_SCHEMA)
        return self.spark.read.schema(EVENT_SCHEMA).json(self.events_path)

    def _event(self, version: str, kind: str) -> None:
        self.spark.range(1).select(
            F.lit(version).alias("version"), F.lit(kind).alias("event"), F.current_timestamp().alias("at")
        ).coalesce(1).write.mode("append").option("timestampFormat", _ISO + "XXX").json(self.events_path)

    def metadata(self, version: str) -> dict[str, Any]:
        """The whole metadata object of a live version, as it was saved, with defaults for absent fields."""
        row = self.versions().where(F.col("version") == version).head()
        if row is None:
            raise UnknownVersionError(f"Model version '{version}' not found")
        fields = row.asDict(recursive=True)
        return fields | json.loads(fields.pop("document")) | {"version": fields["version"]}

    def latest(self) -> str:
        found = latest_version(self.versions()).first().version
        if found is None:
            raise UnknownVersionError("No models found")
        return found

    def deployed(self) -> str | None:
        return deployed_version(self.events()).first().version

    def deploy(self, version: str) -> None:
        """Make a version the deployed one; going back to an old one is the same call."""
        self._files(version)
        self._event(version, "deploy")

    def delete(self, version: str) -> None:
        """Retire a version; the deployed one is refused. Its files stay until cleaned up."""
        self.metadata(version)
        if self.deployed() == version:
            raise ValueError(f"Cannot delete currently deployed version '{version}'")
        self._event(version, "delete")

    def load(self, version: str | None = None) -> tuple[str, AttritionModel]:
        """(version, model); without a version the deployed one, else the latest."""
        version = version or self.deployed() or self.latest()
        meta, folder = self.metadata(version), self._files(version)
        return version, AttritionModel(
            PipelineModel.load(f"{folder}/chain"),
            FittedEncoder.load(self.spark, f"{folder}/encoder"),
            meta["params"],
            meta["monthly_median"],
        )

    def leaves(self, version: str) -> LeafTable:
        """The leaf table of a saved version, for attributions."""
        pattern = f"{self._files(version)}/chain/stages/*_GBTClassifier_*"
        jvm = self.spark.sparkContext._jvm  # noqa: SLF001
        path = jvm.org.apache.hadoop.fs.Path(pattern)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
        stage = fs.globStatus(path)[0].getPath().toString()
        return read_leaf_table(self.spark, stage, int(self.metadata(version)["n_features"]))
