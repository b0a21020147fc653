"""Category codes of model features as a table, for columns with any number of values.

The sorted values of each column, their codes and nothing else are one written
table; a column is coded by joining that table, which Spark sends to every task
only if it is small. No list of values is ever on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import unwrap_udt

from tidemark.operators.ranking import fresh, positions
from tidemark.session import materialize


class CategoryCodes(Transformer, MLWritable, MLReadable):
    """Adds ``out`` columns with the code of each ``cols`` column: its place among the sorted training values.

    A value that training has not seen, and a missing one, get the number of
    known values as their code.
    """

    def __init__(self, cols: Sequence[str] = (), out: Sequence[str] = (), sizes: Sequence[int] = (), table: DataFrame | None = None):
        super().__init__()
        self.cols, self.out, self.sizes, self.table = list(cols), list(out), list(sizes), table

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str], out: Sequence[str]) -> CategoryCodes:
        """Learn the values of text columns."""
        values = [F.struct(F.lit(i).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for i, c in enumerate(cols)]
        known = df.select(F.inline(F.array(*values))).where("value is not null").distinct()
        # All columns in one sort: a code is the place less that of the column's first value.
        placed = materialize(positions(known, [F.col("column"), F.col("value")], "place"), "category-codes", "column")
        facts = placed.groupBy("column").agg(F.min("place").alias("first"), F.count("*").alias("n")).collect()  # one row a column
        firsts, sizes = {r["column"]: r["first"] for r in facts}, {r["column"]: r["n"] for r in facts}
        first = F.get(F.array(*[F.lit(firsts.get(i, 0)) for i in range(len(cols))]), F.col("column"))
        table = placed.select("column", "value", (F.col("place") - first).cast("int").alias("code"))
        return cls(cols, out, [sizes.get(i, 0) for i in range(len(cols))], table)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        for i, (col, out, size) in enumerate(zip(self.cols, self.out, self.sizes, strict=True)):
            value, code = fresh(dataset, "_value"), fresh(dataset, "_code")
            codes = self.table.where(F.col("column") == i).select(F.col("value").alias(value), F.col("code").alias(code))
            coded = dataset.join(codes, F.col(f"`{col}`").cast("string") == F.col(value), "left")
            coded = coded.withColumn(out, F.coalesce(code, F.lit(size)).cast("double")).drop(value, code)
            # The encoder reads the number of values from here, so it need not pass over the rows.
            dataset = coded.withMetadata(out, {"ml_attr": {"type": "nominal", "num_vals": max(size, 1)}})
        return dataset

    def write(self) -> MLWriter:
        return _CodesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _CodesReader()


class _CodesWriter(MLWriter):
    def __init__(self, codes: CategoryCodes):
        super().__init__()
        self.codes = codes

    def saveImpl(self, path: str) -> None:  # noqa: N802 - the name Spark calls
        facts = {"cols": self.codes.cols, "out": self.codes.out, "sizes": self.codes.sizes}
        DefaultParamsWriter.saveMetadata(self.codes, path, self.sparkSession, extraMetadata=facts)
        self.codes.table.write.partitionBy("column").parquet(f"{path}/codes")


class _CodesReader(MLReader):
    def load(self, path: str) -> CategoryCodes:
        spark = SparkSession.active()
        facts = DefaultParamsReader.loadMetadata(path, spark)
        table = spark.read.schema("value string, code int, column int").parquet(f"{path}/codes")
        codes = CategoryCodes(facts["cols"], facts["out"], facts["sizes"], table)
        codes._resetUid(facts["uid"])
        return codes


def one_hot_stages(df: DataFrame, cols: Sequence[str], codes: Sequence[str], vectors: Sequence[str]) -> list:
    """Fitted codes of text columns, and the encoder that makes sparse vectors of them; what is unseen becomes all zeros."""
    coded = CategoryCodes.fit(df, cols, codes)
    return [coded, OneHotEncoder(inputCols=list(codes), outputCols=list(vectors), dropLast=True, handleInvalid="keep")]


def one_hot_vectors(df: DataFrame, col: str, out: str) -> DataFrame:
    """``df`` with a sparse vector of the category of ``col``: one place for each of its values in sorted order, however many; a missing value is all zeros."""
    code = fresh(df, "_one_hot")
    coded, encoder = one_hot_stages(df, [col], [code], [out])
    rows = coded.transform(df)
    return encoder.fit(rows).transform(rows).drop(code)


def hot_places(df: DataFrame, vector: str) -> DataFrame:
    """``df`` with the size of a one-hot vector and the place that is set (-1: none)."""
    parts = unwrap_udt(vector)
    return df.withColumns({"size": parts["size"], "place": F.coalesce(F.get(parts["indices"], F.lit(0)), F.lit(-1))})
