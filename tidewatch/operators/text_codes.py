"""Text features as numbers: a fitted, persistable stage whose codes are a table, never a list in the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.features import label_codes
from tidewatch.session import BROADCAST_BYTES, materialize, scratch_folder

# Bytes of a code and of a hash table's entry beside the text.
ENTRY_BYTES = 64


class _CodesWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.codes().write.parquet(f"{path}/codes")


class _CodesReader(DefaultParamsReader):
    def load(self, path: str):
        return super().load(path)._set(table=f"{path}/codes")


class TextCodesModel(Transformer, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the code of every input column's text as a double; null and unseen texts get the code after the last.

    ``table`` is the Parquet table ``column, value, code``, ``sizes`` and ``bytes`` are the number and the total text bytes of each column's
    codes, counted when fitted. A column whose codes are measured to be small is joined by broadcast, so rows stay where they are; others
    by a shuffled join, where adaptive execution splits hot texts.
    """

    table = Param(Params._dummy(), "table", "folder of the codes", TypeConverters.toString)
    sizes = Param(Params._dummy(), "sizes", "number of codes of each input column", TypeConverters.toListInt)
    bytes = Param(Params._dummy(), "bytes", "bytes of the texts of each input column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None, table=None, sizes=None, bytes=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def codes(self) -> DataFrame:
        return SparkSession.active().read.schema("column string, value string, code long").parquet(self.getOrDefault("table"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if not self.getInputCols():
            return dataset
        codes = self.codes()
        for c, out, size, width in zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault("sizes"), self.getOrDefault("bytes")):
            own = codes.where(F.col("column") == c).select(F.col("value").alias("_code_value"), F.col("code").cast("double").alias(out))
            if width + ENTRY_BYTES * size <= BROADCAST_BYTES:
                own = F.broadcast(own)
            dataset = dataset.join(own, F.col(c) == F.col("_code_value"), "left").drop("_code_value")
            dataset = dataset.withColumn(out, F.coalesce(F.col(out), F.lit(float(size))))
        return dataset

    def write(self) -> DefaultParamsWriter:
        return _CodesWriter(self)

    @classmethod
    def read(cls) -> DefaultParamsReader:
        return _CodesReader(cls)


class TextCodes(Estimator, HasInputCols, HasOutputCols):
    """Numbers the distinct texts of each input column from 0 in sorted order, by ``label_codes``, and writes them as a table.

    The table lies in the shared scratch folder until the model is saved, which takes its own copy along.
    """

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TextCodesModel:
        columns = self.getInputCols()
        spark, table = dataset.sparkSession, scratch_folder(dataset.sparkSession)
        if columns:
            label_codes(materialize(dataset.select(*columns)), columns).select("column", "value", F.col("code").cast("bigint").alias("code")).write.parquet(table)
            counted = spark.read.parquet(table).groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value")).alias("b"))
            found = {row["column"]: (row["n"], float(row["b"])) for row in counted.collect()}  # one row per column
        sizes, widths = zip(*[found.get(c, (0, 0.0)) for c in columns]) if columns else ((), ())
        return TextCodesModel(inputCols=columns, outputCols=self.getOutputCols(), table=table, sizes=list(sizes), bytes=list(widths))
