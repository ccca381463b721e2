"""A small table that says which folder holds which copy of a table."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import astuple, dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granero.sources.folders import join_path

SCHEMA = (
    "name string, path string, columns string, created_at timestamp, expires_at timestamp, "
    "row_count bigint"
)


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass(frozen=True)
class Entry:
    """A complete copy of a table; ``columns`` is its schema as JSON.

    ``path`` names one folder, or several with a newline between them.
    """

    name: str
    path: str
    columns: str
    created_at: datetime
    expires_at: datetime | None = None
    row_count: int | None = None

    @property
    def folders(self) -> list[str]:
        return self.path.split("\n")

    def read(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(self.columns))
        return spark.read.schema(schema).parquet(*self.folders).select(*schema.names)


class Manifest:
    """Entries are only ever added, after the data they point to is complete."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.path = join_path(base, "manifest")

    def entries(self) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SCHEMA)

    def add(self, entries: Iterable[Entry]) -> None:
        types = T.StructType.fromDDL(SCHEMA)
        rows = F.array(
            *(
                F.struct(
                    *(
                        F.lit(value).cast(field.dataType).alias(field.name)
                        for value, field in zip(astuple(entry), types)
                    )
                )
                for entry in entries
            )
        )
        table = self.spark.range(1, numPartitions=1).select(F.inline(rows))
        table.write.mode("append").parquet(self.path)

    def newest(self, names: Iterable[str], now: datetime | None = None) -> dict[str, Entry]:
        """The latest entry of each name that has not expired at ``now``."""
        live = F.col("expires_at").isNull() | (F.col("expires_at") > F.lit(now or utc_now()))
        fields = list(Entry.__annotations__)
        others = [field for field in fields if field != "created_at"]
        latest = (
            self.entries()
            .where(F.col("name").isin(list(names)) & live)
            .groupBy("name")
            .agg(F.max(F.struct("created_at", *others)).alias("entry"))
        )
        return {
            found["name"]: Entry(*(found["entry"][field] for field in fields))
            for found in latest.collect()
        }
