"""The batch job as composable stages: raw -> clean -> enriched (silver) -> gold.

Unlike a chain of uncached actions, silver is materialised once (written) and
gold and the reports read it back, so every output agrees on which duplicate
survived and the expensive scan / dedup shuffle runs once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tardy.functions.clock import add_calendar_columns, flight_date
from tardy.functions.codes import airline_dimension, airport_dimension, normalize_flight_codes
from tardy.functions.flags import add_flags
from tardy.functions.metrics import ALL_METRICS
from tardy.operators.aggregate import CODE_KEYS, daily_gold, window_gold
from tardy.operators.clean import clean_flights
from tardy.operators.enrich import attach_names, enrich_flights, guarded_dimension
from tardy.schema import BATCH_LABEL, GOLD_KEYS, STREAM_LABEL
from tardy.session import shuffles_removed, stored, with_plan_settings
from tardy.sinks import parquet as sinks
from tardy.sinks import table
from tardy.sinks.audit import enrichment_log_lines, guarded_write, write_lines
from tardy.sources import testdata
from tardy.streaming.pipeline import stream_rows


@dataclass
class Inputs:
    flights: DataFrame      # raw fact (codes not yet normalised)
    airlines: DataFrame     # normalised airline dimension
    airports: DataFrame     # normalised airport dimension


def testdata_inputs(spark: SparkSession, sf_dir: str, stream: bool = False) -> Inputs:
    flights = (testdata.flights_stream if stream else testdata.flights)(spark, sf_dir)
    return Inputs(
        flights=flights,
        airlines=airline_dimension(testdata.airlines_raw(spark, sf_dir)),
        airports=airport_dimension(testdata.airports_raw(spark, sf_dir)),
    )


def cleaned(inputs: Inputs) -> DataFrame:
    """Batch cleaning: normalise codes, quality filters, deterministic dedup."""
    return clean_flights(normalize_flight_codes(inputs.flights))


def enriched(inputs: Inputs) -> DataFrame:
    """Silver rows: cleaned facts joined to both dimensions, FL_DATE and DEP_HOUR added."""
    return add_calendar_columns(enrich_flights(cleaned(inputs), inputs.airlines, inputs.airports))


def features(inputs: Inputs) -> DataFrame:
    return add_flags(enriched(inputs))


def gold_by_code(rows: DataFrame, airlines: DataFrame, airports: DataFrame,
                 metrics: list[str] | None = None, label: str | None = BATCH_LABEL,
                 processed_at: bool = False) -> DataFrame:
    """Daily statistics of flagged rows: aggregate by code (FL_DATE, AIRLINE,
    ORIGIN_AIRPORT), then attach airline / origin names to the aggregated rows.
    Same result as aggregating name-carrying rows (dimension keys are proven
    unique), without joining every fact row or shuffling names; on silver the
    name columns are not even read."""
    by_code = daily_gold(rows, metrics or ALL_METRICS, label=None, keys=CODE_KEYS)
    out = attach_names(by_code, airlines, airports)
    out = out.select(*GOLD_KEYS, *[c for c in by_code.columns if c not in GOLD_KEYS])
    if label is not None:
        out = out.withColumn("aggregation_type", F.lit(label))
    return out.withColumn("processed_at", F.current_timestamp()) if processed_at else out


def gold(inputs: Inputs, metrics: list[str] | None = None,
         label: str | None = BATCH_LABEL) -> DataFrame:
    """Daily statistics from raw facts (the destination join is not needed at all)."""
    rows = add_flags(add_calendar_columns(cleaned(inputs)))
    return gold_by_code(rows, inputs.airlines, inputs.airports, metrics, label)


def input_dates(inputs: Inputs) -> DataFrame:
    """FL_DATE of the input's rows as text, each once (a scan of three columns)."""
    return inputs.flights.select(flight_date().cast("string").alias("FL_DATE")).where("FL_DATE is not null").distinct()


def stream_window_gold(inputs: Inputs) -> DataFrame:
    """The stream job's window statistics computed on a bounded frame (no watermark)."""
    by_code = window_gold(stream_rows(inputs.flights), keys=CODE_KEYS, label=None)
    return attach_names(by_code, inputs.airlines, inputs.airports).withColumn(
        "aggregation_type", F.lit(STREAM_LABEL))


def _store_silver(inputs: Inputs, silver_path: str, only_its_dates: bool) -> dict:
    """Writes silver in two statements: the rows that the dedup keeps, then the same by date, with names. Each
    shuffles all rows, and the disk holds one of the two shuffles at a time (the stored rows are far smaller). Names
    that are broadcast are joined behind the second shuffle, which then doesn't carry them."""
    airlines = guarded_dimension(inputs.airlines, "AIRLINE_CODE")
    airports = guarded_dimension(inputs.airports, "AIRPORT_CODE")
    broadcast = airlines is not inputs.airlines and airports is not inputs.airports
    with shuffles_removed(inputs.flights.sparkSession), stored(cleaned(inputs), "clean") as clean:
        if broadcast:
            clean = sinks.clustered(clean.withColumn("FL_DATE", flight_date()), sinks.SILVER_PARTITIONS).drop("FL_DATE")
        rows = add_calendar_columns(enrich_flights(clean, airlines, airports, guard=False))
        return sinks.write_silver(rows, silver_path, only_its_dates, broadcast)


@with_plan_settings
def run_batch(spark: SparkSession, inputs: Inputs, silver_path: str, gold_path: str,
              warehouse_path: str | None = None, log_path: str | None = None,
              audit_path: str | None = None, only_its_dates: bool = False,
              warehouse_table: str | None = None, warehouse_location: str | None = None) -> dict | None:
    """Whole batch job: silver write, diagnostics, gold from the written silver.

    A run replaces silver and the batch part of gold, so nothing of an earlier run
    reaches this run's outputs. With ``only_its_dates`` (a run over some dates) it
    replaces the dates of its input, those that lost all rows included, and reads back those dates only. The
    diagnostics are counted by the tasks that write silver, so reporting them reads nothing again; only the
    example codes of the log do. They don't stop the
    job: if they fail, that is recorded and None is returned. With ``audit_path`` each write's outcome is recorded there and failures are
    raised; the optional warehouse targets (a folder, a table of the session's catalogue) receive the same gold rows."""

    def step(name: str, fn) -> None:
        if audit_path:
            guarded_write(spark, name, fn, audit_path)
        else:
            fn()

    seen: dict = {}
    step("silver", lambda: seen.update(_store_silver(inputs, silver_path, only_its_dates)))
    silver = sinks.read_silver(spark, silver_path)
    emptied: list[str] = []
    if only_its_dates:  # a row per date
        written = seen["dates"]
        emptied = sorted({r[0] for r in input_dates(inputs).collect()} - set(written))
        sinks.drop_dates(spark, silver_path, emptied)
        silver = silver.where(F.col("FL_DATE").isin([F.lit(d).cast("date") for d in written]))
    diag: dict | None = None

    def report() -> None:
        nonlocal diag
        diag = {c: seen[c] for c in ("total_rows", "origin_missing", "dest_missing")}
        if log_path:
            write_lines(enrichment_log_lines(silver, counts=diag), log_path)

    try:
        step("diagnostics", report)
    except Exception as e:
        print(f"diagnostics failed, gold goes on: {e}")
    gold_rows = gold_by_code(add_flags(silver), inputs.airlines, inputs.airports, processed_at=True)

    def target(rows: DataFrame, path: str) -> None:
        if only_its_dates:
            sinks.write_gold(rows, path)
            sinks.drop_dates(spark, f"{path}/aggregation_type={BATCH_LABEL}", emptied)
        else:
            sinks.replace_gold(rows, path, BATCH_LABEL)

    step("gold", lambda: target(gold_rows, gold_path))
    if not (warehouse_path or warehouse_table):
        return diag
    written_gold = sinks.read_gold(spark, gold_path).where(F.col("aggregation_type") == BATCH_LABEL).drop("load_id")
    if only_its_dates:
        written_gold = written_gold.where(F.col("FL_DATE").isin([F.lit(d).cast("date") for d in written]))
    if warehouse_path:
        step("warehouse", lambda: target(written_gold, warehouse_path))

    def table_target() -> None:
        if only_its_dates:
            table.insert_gold(written_gold, warehouse_table, location=warehouse_location)
            table.empty_dates(spark, warehouse_table, BATCH_LABEL, emptied)
        else:
            table.replace_gold_rows(written_gold, warehouse_table, BATCH_LABEL, location=warehouse_location)

    if warehouse_table:
        step("warehouse table", table_target)
    return diag
