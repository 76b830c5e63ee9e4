from tardy.streaming.pipeline import (
    StreamJob,
    gold_batch_writer,
    latest_window_values,
    stream_features,
    update_writer,
    windowed_gold,
)

__all__ = ["StreamJob", "gold_batch_writer", "latest_window_values", "stream_features",
           "update_writer", "windowed_gold"]
