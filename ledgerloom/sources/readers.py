"""Scans of the source systems."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.config import BUSINESS_ZONE
from ledgerloom.sources.contracts import CORE, SPECS, TRANSACTIONS, TableSpec

_DRIVERS = {CORE: "org.postgresql.Driver", TRANSACTIONS: "com.mysql.cj.jdbc.Driver"}
_SCHEMA_PREFIX = {CORE: "public.", TRANSACTIONS: ""}


def jdbc_options(
    spec: TableSpec,
    connection: Mapping[str, str],
    bounds: tuple[int, int, int] | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a parallel JDBC scan.

    ``bounds`` is (lowest key, highest key, number of partitions); the scan is split on the merge key.
    It only places the cuts: rows outside the bounds still arrive, in the first or last partition.
    DATETIME columns are read as wall time, and MySQL sessions run in the bank's zone. Without a cursor the MySQL
    driver holds a partition's whole result in memory, whatever the fetch size.
    """
    url = connection["url"]
    if spec.system == TRANSACTIONS:
        for name, value in (("connectionTimeZone", BUSINESS_ZONE), ("useCursorFetch", "true")):
            if name not in url:
                url += ("&" if "?" in url else "?") + f"{name}={value}"
    options = {
        "url": url,
        "dbtable": _SCHEMA_PREFIX[spec.system] + spec.name,
        "driver": connection.get("driver", _DRIVERS[spec.system]),
        "fetchsize": str(fetch_size),
        "preferTimestampNTZ": "true",
        "pushDownPredicate": "true",
    }
    options.update({k: v for k, v in connection.items() if k in ("user", "password")})
    if bounds is not None:
        low, high, parts = bounds
        options.update(
            partitionColumn=spec.key, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts)
        )
    return options


def month_predicates(column: str, first: date, last: date) -> list[str]:
    """One predicate per calendar month, for ``spark.read.jdbc(predicates=...)``.

    The source fact table is range-partitioned by month, so each Spark partition reads one source
    partition. Rows before the first month and from after the last one get a predicate each as well.
    """
    starts, y, m = [], first.year, first.month
    while (y, m) <= (last.year, last.month):
        starts.append(date(y, m, 1))
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    end = date(y, m, 1)
    inner = [f"{column} >= '{a}' AND {column} < '{b}'" for a, b in zip(starts, [*starts[1:], end])]
    return [f"{column} < '{starts[0]}'", *inner, f"{column} >= '{end}'"]


def read_source(
    spark: SparkSession,
    spec: TableSpec,
    *,
    connection: Mapping[str, str] | None = None,
    path: str | None = None,
    table: str | None = None,
    bounds: tuple[int, int, int] | None = None,
    months: tuple[str, date, date] | None = None,
) -> DataFrame:
    """Scan one source table from a JDBC connection, a parquet path or a catalog table.

    All three give Catalyst a scan that prunes columns and takes pushed filters. ``months``, a date column with its
    first and last day, splits a JDBC scan by month instead of by ``bounds`` of the key.
    """
    if sum(x is not None for x in (connection, path, table)) != 1:
        raise ValueError("give exactly one of connection, path, table")
    if path is not None:
        return spark.read.parquet(path)
    if table is not None:
        return spark.table(table)
    options = jdbc_options(spec, connection, None if months else bounds)
    if months is None:
        return spark.read.format("jdbc").options(**options).load()
    return spark.read.jdbc(
        options.pop("url"), options.pop("dbtable"), predicates=month_predicates(*months), properties=options
    )


def sources_from_jdbc(
    spark: SparkSession, connections: Mapping[str, Mapping[str, str]]
) -> dict[str, Callable[[], DataFrame]]:
    """Catalog sources from the source systems: system name -> connection."""
    return {
        n: (lambda s=s: read_source(spark, s, connection=connections[s.system]))
        for n, s in SPECS.items()
        if s.system in connections
    }


def sources_from_tables(spark: SparkSession, schemas: Mapping[str, str]) -> dict[str, Callable[[], DataFrame]]:
    """Catalog sources from raw tables: system name -> schema, e.g. ``{"core_banking": "raw_core"}``."""
    return {
        n: (lambda s=s: read_source(spark, s, table=f"{schemas[s.system]}.{s.name}"))
        for n, s in SPECS.items()
        if s.system in schemas
    }


def sources_from_path(spark: SparkSession, root: str) -> dict[str, Callable[[], DataFrame]]:
    """Catalog sources from parquet folders or files ``<root>/<table>.parquet``."""
    return {n: (lambda s=s: read_source(spark, s, path=f"{root}/{s.name}.parquet")) for n, s in SPECS.items()}
