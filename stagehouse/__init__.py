"""Moving tables between Spark and a warehouse through staged columnar files."""

from stagehouse.errors import LoadError, OptionError, SchemaError, StagedTransferError
from stagehouse.functions import conform, ddl_for
from stagehouse.operators import CatalogWarehouse, Distribution, JdbcWarehouse
from stagehouse.options import Options, open_warehouse, read, write
from stagehouse.sources import StagedDataset, StagingArea

__all__ = [
    "CatalogWarehouse",
    "Distribution",
    "JdbcWarehouse",
    "LoadError",
    "OptionError",
    "Options",
    "SchemaError",
    "StagedDataset",
    "StagedTransferError",
    "StagingArea",
    "conform",
    "ddl_for",
    "open_warehouse",
    "read",
    "write",
]
