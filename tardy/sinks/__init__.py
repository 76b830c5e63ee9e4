from tardy.sinks.parquet import read_gold, read_silver, write_gold, write_silver

__all__ = ["read_gold", "read_silver", "write_gold", "write_silver"]
