"""Sinks of the published table, and the way readers find the newest: S3, S6 to S9.

    publications/run=N-K/...   all files of the K-th publication after run N, written once
    shown/no=M                 one row, written last: which of them the M-th shown one is
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.publishing import flat_lists
from tidemark.session import CODEC, folder_names

_SHOWN = "no long, run long, publication string, rows long"


def replace_table(df: DataFrame, path: str) -> None:
    """S3: load in replace mode. ``path`` must not be one the plan reads from."""
    df.write.mode("overwrite").parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    """Lists stay lists."""
    df.write.mode("overwrite").option("compression", CODEC).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Lists as text; quotes doubled, line breaks kept inside quotes."""
    (flat_lists(df).write.mode("overwrite")
     .option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def read_csv(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Reads a CSV written by ``write_csv``; the schema comes from the table it was made of."""
    schema = flat_lists(like).schema
    # A null value that no text equals keeps missing and empty ("") fields apart.
    return (spark.read.schema(schema).option("header", True).option("quote", '"')
            .option("escape", '"').option("multiLine", True).option("nullValue", "\u0000")
            .csv(path))


def publish_min(minimal: DataFrame, folder: str, license_text: str) -> None:
    """The published columns in both formats, and the licence."""
    spark = minimal.sparkSession
    write_parquet(minimal, f"{folder}/min_data_format.parquet")
    # The CSV is made from the written table, so HTML is not converted twice.
    write_csv(spark.read.parquet(f"{folder}/min_data_format.parquet"),
              f"{folder}/min_data_format.csv")
    (spark.range(1).select(F.lit(license_text).alias("value"))
     .coalesce(1).write.mode("overwrite").text(f"{folder}/LICENSE-DATA"))


@dataclass(frozen=True)
class Publication:
    """A folder of files that belong together; readers see it once ``show`` has named it."""

    spark: SparkSession
    folder: str
    name: str
    run: int

    @property
    def root(self) -> str:
        return f"{self.folder}/publications/{self.name}"

    def path(self, file: str) -> str:
        return f"{self.root}/{file}"

    @classmethod
    def begin(cls, spark: SparkSession, folder: str, run: int) -> Publication:
        """A new folder: earlier ones, shown or left by a failure, are never written to."""
        folder = folder.rstrip("/")
        before = [n for n in folder_names(spark, f"{folder}/publications") if n.startswith(f"run={run}-")]
        tried = max((int(n.rpartition("-")[2]) for n in before), default=-1)
        return cls(spark, folder, f"run={run}-{tried + 1}", run)

    def show(self, rows: int) -> None:
        numbers = [int(n[3:]) for n in folder_names(self.spark, f"{self.folder}/shown") if n.startswith("no=")]
        number = max(numbers, default=-1) + 1
        self.spark.createDataFrame([(number, self.run, self.name, rows)], _SHOWN).coalesce(1).write.parquet(
            f"{self.folder}/shown/no={number}")

    @classmethod
    def newest(cls, spark: SparkSession, folder: str) -> Publication:
        """The publication that was shown last; a pointer whose writing failed counts for nothing."""
        folder = folder.rstrip("/")
        names = [f"{folder}/shown/{n}" for n in folder_names(spark, f"{folder}/shown") if n.startswith("no=")]
        rows = spark.read.schema(_SHOWN).parquet(*names).collect() if names else []
        if not rows:
            raise FileNotFoundError(f"nothing is published in {folder}")
        row = max(rows, key=lambda r: r.no)
        return cls(spark, folder, row.publication, row.run)


def read_published(spark: SparkSession, folder: str, file: str = "data.parquet") -> DataFrame:
    """A Parquet file of the newest publication."""
    return spark.read.parquet(Publication.newest(spark, folder).path(file))
