"""Derived tables in versioned folders, and one pointer file that says which versions are current."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from riskflow.session import file_system, remove_dir
from riskflow.sources.tables import children

POINTER = "_current.json"


class VersionedTables:
    """Tables below ``root``; a set of new versions takes the place of the old ones at once.

    Each version is a folder of its own. Readers look up the folders in the pointer, which is replaced
    by one rename over the old one. Stopped at any step, all tables are the old ones or all are the new.
    Versions that are current or were so last are kept, so plans made before a switch still run.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _pointed(self) -> dict[str, dict[str, str]]:
        files, path = file_system(self.spark, f"{self.root}/{POINTER}")
        if not files.exists(path):
            return {"current": {}, "last": {}}
        source = files.open(path)
        try:
            return json.loads(bytes(source.readAllBytes()).decode("utf-8"))
        finally:
            source.close()

    def current(self) -> dict[str, str]:
        """Name -> folder of the version that readers see."""
        return self._pointed()["current"]

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.current()[name])

    def write(self, name: str, rows: DataFrame) -> str:
        """Write a version that nobody sees yet; returns its folder."""
        folder = f"{self.root}/{name}/version={uuid.uuid4().hex}"
        rows.write.parquet(folder)
        return folder

    def switch(self, folders: dict[str, str]) -> None:
        """Make written versions the current ones, all at once; other tables stay as they are."""
        before = self.current()
        self._point({"current": {**before, **folders}, "last": before})
        self._clean()

    def _point(self, pointed: dict[str, dict[str, str]]) -> None:
        aside, place = f"{self.root}/_pointer-{uuid.uuid4().hex}", f"{self.root}/{POINTER}"
        files, path = file_system(self.spark, aside)
        out = files.create(path, True)
        try:
            out.write(bytearray(json.dumps(pointed), "utf-8"))
        finally:
            out.close()
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        rename = getattr(hadoop, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context = hadoop.FileContext.getFileContext(files.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(path, hadoop.Path(place), options)

    def _clean(self) -> None:
        """Remove the versions that are neither current nor were so last."""
        pointed = self._pointed()
        kept = {*pointed["current"].values(), *pointed["last"].values()}
        for name in pointed["current"]:
            for version in children(self.spark, f"{self.root}/{name}"):
                folder = f"{self.root}/{name}/{version}"
                if folder not in kept:
                    remove_dir(self.spark, folder)
