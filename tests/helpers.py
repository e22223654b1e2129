"""Small hand-written relations for edge cases."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerloom.catalog import Catalog
from ledgerloom.config import RunContext
from ledgerloom.sources.contracts import SPECS
from ledgerloom.sources.dims import DIMS
from ledgerloom.sources.testbed import dim_source

AS_OF = date(2024, 6, 30)
CTX = RunContext(as_of=AS_OF, as_of_ts=datetime(2024, 6, 30))
DAY0 = datetime(2024, 1, 1)

BLANKS = {
    T.LongType: 1,
    T.StringType: "x",
    T.DateType: date(2024, 1, 1),
    T.BooleanType: True,
    T.TimestampNTZType: DAY0,
    T.DecimalType: Decimal("1"),
}


def rows(spark: SparkSession, table: str, *records: dict) -> DataFrame:
    """Rows of a source table. Unnamed required columns get a filler, unnamed nullable ones are null."""
    schema = SPECS[table].schema
    blank = {f.name: None if f.nullable else BLANKS[type(f.dataType)] for f in schema}
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    data = []
    for r in records:
        assert not set(r) - set(blank), set(r) - set(blank)
        full = blank | r
        data.append(
            tuple(
                Decimal(str(v)) if isinstance(f.dataType, T.DecimalType) and v is not None else v
                for f, v in ((f, full[f.name]) for f in schema)
            )
        )
    return spark.createDataFrame(data, loose)


def mini(spark: SparkSession, ctx: RunContext = CTX, **tables: DataFrame) -> Catalog:
    sources = {n: (lambda n=n: rows(spark, n)) for n in SPECS}
    sources |= {n: (lambda n=n: dim_source(spark, n)) for n in DIMS}
    sources |= {n: (lambda df=df: df) for n, df in tables.items()}
    return Catalog(sources, ctx)


def by_key(df: DataFrame, key: str) -> dict:
    return {r[key]: r for r in df.collect()}
