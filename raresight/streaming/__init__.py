from raresight.streaming.jobs import (
    closed_loop,
    delayed_label_join,
    read_table_stream,
    score_stream,
    streaming_drift_alerts,
    windowed_bin_counts,
)

__all__ = ["closed_loop", "delayed_label_join", "read_table_stream", "score_stream", "streaming_drift_alerts", "windowed_bin_counts"]
