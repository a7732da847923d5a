from stagehouse.functions.casts import conform, widens
from stagehouse.functions.ddl import ddl_for
from stagehouse.functions.names import quote_name, split_name

__all__ = ["conform", "ddl_for", "quote_name", "split_name", "widens"]
