from tardy.operators.aggregate import daily_gold, window_gold
from tardy.operators.clean import apply_quality_filters, clean_flights, dedup_first, rejection_report
from tardy.operators.enrich import (
    enrich_flights,
    enrichment_diagnostics,
    guarded_dimension,
    unmatched_code_counts,
    unmatched_code_examples,
)

__all__ = [
    "daily_gold", "window_gold", "apply_quality_filters", "clean_flights", "dedup_first",
    "rejection_report", "enrich_flights", "enrichment_diagnostics", "guarded_dimension",
    "unmatched_code_counts", "unmatched_code_examples",
]
