from tardy.functions.clock import add_calendar_columns, add_event_time, clock_hour, event_time, flight_date
from tardy.functions.codes import airline_dimension, airport_dimension, normalize_flight_codes, normalized_code
from tardy.functions.flags import add_flags, flag_columns
from tardy.functions.metrics import ALL_METRICS, METRIC_GROUPS, aggregate_metrics

__all__ = [
    "add_calendar_columns", "add_event_time", "clock_hour", "event_time", "flight_date",
    "airline_dimension", "airport_dimension", "normalize_flight_codes", "normalized_code",
    "add_flags", "flag_columns", "ALL_METRICS", "METRIC_GROUPS", "aggregate_metrics",
]
