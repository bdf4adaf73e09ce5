"""Large lists laid out so that a page costs the files that hold it: clustered by ranges of the order, with a directory of the files.

The list is sorted once, when it is written. The directory has a row for each file: its first and last place in the order, its
rows and the rows before it. Pages, a key's page and the pages of a prefix look there and then read one file or a few.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ROWS_PER_FILE = 100_000


def write_list(df: DataFrame, path: str, order: Sequence[str], rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write df below `path` in ascending `order` (nulls first), which should name each row; for a descending one write its negation too."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/data")
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{path}/data")
    place = F.struct(*order)
    files = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"), F.min(place).alias("first"), F.max(place).alias("last"))
    before = Window.orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    files.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).coalesce(1).write.parquet(f"{path}/directory")


class PagedList:
    """A list that write_list() has written; schema is that of its rows."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, order: Sequence[str]) -> None:
        self.spark, self.path, self.schema, self.order = spark, path, schema, list(order)
        self.directory = spark.read.parquet(f"{path}/directory")
        self.total = self.directory.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def _rows(self, files: list) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f["file"] for f in files))

    def _between(self, low: int, high: int) -> DataFrame:
        """Rows low..high-1 of the list, in order."""
        files = self.directory.filter((F.col("start") < high) & (F.col("start") + F.col("n") > low)).orderBy("start").collect()
        ahead = low - files[0]["start"] if files else 0
        return self._rows(files).orderBy(*self.order).offset(ahead).limit(max(high - low, 0))

    def page(self, number: int, size: int) -> tuple[DataFrame, int]:
        """(rows, number): a page in order, its number kept within what there is."""
        number = min(max(1, number), max(1, -(-self.total // size)))
        return self._between((number - 1) * size, min(number * size, self.total)), number

    def _place(self, key: Sequence) -> Column:
        return F.struct(*(F.lit(v).cast(self.schema[c].dataType).alias(c) for c, v in zip(self.order, key, strict=True)))

    def rank(self, key: Sequence) -> int:
        """How many rows come before a key, which need not be there; at most one file is read."""
        place = self._place(key)
        whole = self.directory.filter(F.col("last") < place).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        files = self.directory.filter((F.col("first") < place) & (F.col("last") >= place)).collect()
        return whole + (self._rows(files).filter(F.struct(*self.order) < place).count() if files else 0)

    def page_of(self, key: Sequence, size: int) -> tuple[DataFrame, int]:
        """The page that a key is on, or would be on."""
        return self.page(self.rank(key) // size + 1, size)

    def prefix_page(self, prefix: str, number: int, size: int) -> tuple[DataFrame, int, int]:
        """(rows, number, total) of a page of the rows whose first order column, a string, starts with the prefix.

        They stand together. Files that lie within are counted by the directory, and those at the two ends are read.
        """
        first = self.order[0]
        held = self.directory.filter((F.col(f"last.{first}") >= prefix) & ((F.col(f"first.{first}") < prefix) | F.col(f"first.{first}").isNull() | F.col(f"first.{first}").startswith(prefix)))
        inside = F.coalesce(F.col(f"first.{first}").startswith(prefix) & F.col(f"last.{first}").startswith(prefix), F.lit(False))
        ends = held.filter(~inside).collect()
        total = held.filter(inside).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] + sum(self._rows([f]).filter(F.col(first).startswith(prefix)).count() for f in ends)
        number = min(max(1, number), max(1, -(-total // size)))
        begin = min((f["start"] + self._rows([f]).filter(F.col(first).isNull() | (F.col(first) < prefix)).count() for f in ends), default=None)
        known = held.filter(inside).agg(F.min("start")).first()[0]
        begin = min(x for x in (begin, known, self.total) if x is not None)
        low = begin + (number - 1) * size
        return self._between(low, min(low + size, begin + total)), number, total
