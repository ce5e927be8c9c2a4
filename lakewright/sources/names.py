"""Named sources: logical name -> physical table or folder."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakewright.sources.files import read_table


@dataclass(frozen=True)
class Sources:
    """Looks up frames by logical name, as ``group.name`` or plain ``name``."""

    spark: SparkSession
    locations: Mapping[str, str]

    def get(self, name: str) -> DataFrame:
        if name not in self.locations:
            known = ", ".join(sorted(self.locations))
            raise KeyError(f"source '{name}' is not declared; declared: {known}")
        where = self.locations[name]
        return read_table(self.spark, where) if "/" in where else self.spark.table(where)


def view_over_path(spark: SparkSession, view: str, path: str) -> DataFrame:
    """Temporary view over a table folder."""
    read_table(spark, path).createOrReplaceTempView(view)
    return spark.table(view)
