from stagehouse.operators.catalog import CatalogWarehouse
from stagehouse.operators.jdbc import JdbcWarehouse
from stagehouse.operators.layout import Distribution

__all__ = ["CatalogWarehouse", "Distribution", "JdbcWarehouse"]
