from ledgerloom.sources.contracts import CORE, SPECS, TRANSACTIONS, TableSpec
from ledgerloom.sources.dims import DIMS, join_dim, reference_dim
from ledgerloom.sources.readers import (
    jdbc_options,
    month_predicates,
    read_source,
    sources_from_path,
    sources_from_tables,
)

__all__ = [
    "CORE",
    "DIMS",
    "SPECS",
    "TRANSACTIONS",
    "TableSpec",
    "jdbc_options",
    "join_dim",
    "month_predicates",
    "read_source",
    "reference_dim",
    "sources_from_path",
    "sources_from_tables",
]
