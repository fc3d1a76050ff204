from raresight.sources.files import (
    read_csv,
    read_prediction_log,
    read_split,
    write_prediction_log,
    write_report,
    write_splits,
)
from raresight.sources.tables import (
    V_COLUMNS,
    feature_table,
    load,
    returns_table,
    scored_models,
    transaction_table,
)

__all__ = [
    "V_COLUMNS", "feature_table", "load", "read_csv", "read_prediction_log", "read_split",
    "returns_table", "scored_models", "transaction_table", "write_prediction_log",
    "write_report", "write_splits",
]
