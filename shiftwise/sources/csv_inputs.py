"""CSV start of the pipeline: checked rows, and a quarantine for the others.

``read_checked`` looks at every field of every record. A record with the wrong
number of fields, a field that does not fit its declared type, or a missing
value in a required column goes to the quarantine with its cause and its
text; the rest are typed rows. Nothing is inferred and nothing is dropped
silently: ``rejected`` has every record that ``rows`` lacks.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shiftwise.functions.columns import standardize_columns
from shiftwise.sources import schemas
from shiftwise.sources.files import MISSING, write_csv

RECORD = "_record"


class RejectedRows(ValueError):
    """Raised by :meth:`Checked.strict` when a file has bad records."""


@dataclass(frozen=True)
class Checked:
    rows: DataFrame
    rejected: DataFrame  # cause, record

    def causes(self) -> DataFrame:
        """(cause, row_count) of the quarantined records."""
        return self.rejected.groupBy("cause").agg(F.count(F.lit(1)).alias("row_count"))

    def strict(self, path: str) -> DataFrame:
        """The rows, if no record was rejected. One row per cause reaches the driver."""
        found = sorted((r["cause"], r["row_count"]) for r in self.causes().collect())
        if found:
            raise RejectedRows(f"{path}: " + ", ".join(f"{n} x {cause}" for cause, n in found))
        return self.rows


def header_of(spark: SparkSession, path: str) -> list[str]:
    return spark.read.option("header", True).csv(path).columns


def read_checked(spark: SparkSession, path: str, schema: StructType, required=(), snake_case: bool = True) -> Checked:
    """Columns are found by name, in any order; extra ones are ignored, a lacking one fails at once.

    ``NA``-like fields and empty ones are missing. Records end with LF, CR LF or CR.
    """
    names = header_of(spark, path)
    lacking = [f.name for f in schema.fields if f.name not in names]
    if lacking:
        raise ValueError(f"{path}: no column {', '.join(lacking)}")
    text = StructType([StructField(n, StringType()) for n in names] + [StructField(RECORD, StringType())])
    raw = (spark.read.schema(text).option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", True)
           .option("columnNameOfCorruptRecord", RECORD).option("columnPruning", False).csv(path))
    fields, causes = [], [F.when(F.col(RECORD).isNotNull(), F.lit("number of fields"))]
    for f in schema.fields:
        said = F.trim(F.col(f"`{f.name}`"))
        said = F.when(~said.isin(*MISSING), said)
        value = said.try_cast(f.dataType)
        value = F.when(~F.isnan(value), value) if f.dataType.typeName() in ("double", "float") else value
        fields.append(value.alias(f.name))
        bad = said.isNotNull() & said.try_cast(f.dataType).isNull()
        causes.append(F.when(bad, F.lit(f"{f.name}: not {f.dataType.simpleString()}")))
        if f.name in required:
            causes.append(F.when(said.isNull(), F.lit(f"{f.name}: missing")))
    cause = F.coalesce(*causes)
    whole = F.coalesce(F.col(RECORD), F.to_csv(F.struct(*[F.col(f"`{n}`") for n in names])))
    # the cause is a column of the scan's own rows, so that every field is parsed whichever side is read
    judged = raw.withColumn("cause", cause)
    good = judged.where(F.col("cause").isNull()).select(*fields)
    bad = judged.where(F.col("cause").isNotNull()).select("cause", whole.alias("record"))
    return Checked(standardize_columns(good) if snake_case else good, bad)


@dataclass
class CsvInputs:
    """The four input files of a folder: train, features, stores and test (``<name>.csv``, a file or a folder of parts).

    ``strict=False`` goes on without the rejected records; they stay in ``checked[name].rejected``.
    """

    spark: SparkSession
    folder: str
    strict: bool = True

    FILES = {"train": (schemas.SALES, ("Store", "Dept", "Date")), "features": (schemas.FEATURES, ("Store", "Date")),
             "stores": (schemas.STORES, ("Store",)), "test": (schemas.TEST, ("Store", "Dept", "Date"))}
    keys_required: bool = True

    @cached_property
    def checked(self) -> dict[str, Checked]:
        return {name: read_checked(self.spark, self._path(name), schema, keys if self.keys_required else ())
                for name, (schema, keys) in self.FILES.items()}

    def _path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}.csv"

    def _rows(self, name: str) -> DataFrame:
        found = self.checked[name]
        return found.strict(self._path(name)) if self.strict else found.rows

    def sales(self) -> DataFrame:
        return self._rows("train").withColumnRenamed("isholiday", "is_holiday")

    def features(self) -> DataFrame:
        return self._rows("features").withColumnRenamed("isholiday", "is_holiday")

    def stores(self) -> DataFrame:
        return self._rows("stores")

    def test(self) -> DataFrame:
        return self._rows("test").withColumnRenamed("isholiday", "is_holiday")


def write_inputs(folder: str, sales: DataFrame, features: DataFrame, stores: DataFrame, test: DataFrame) -> None:
    """The inputs as header CSV under their file names and headers."""
    for name, df in (("train", sales), ("features", features), ("stores", stores), ("test", test)):
        schema, _ = CsvInputs.FILES[name]
        plain = df.withColumnRenamed("is_holiday", "isholiday")
        out = plain.select(*[F.col(f.name.lower()).alias(f.name) for f in schema.fields])
        write_csv(out, f"{folder.rstrip('/')}/{name}.csv")
