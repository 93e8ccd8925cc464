"""Sources: base-table readers and the adapter views over them."""

from voxlens.sources.tables import Tables, read_jdbc, read_table

__all__ = ["Tables", "read_table", "read_jdbc"]
