from tardy.sources.csv import (
    conform,
    read_dimension_csv,
    read_flights_csv,
    read_flights_stream,
    write_csv,
)

__all__ = ["conform", "read_dimension_csv", "read_flights_csv", "read_flights_stream", "write_csv"]
