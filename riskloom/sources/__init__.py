"""Reading inputs and writing results."""

from riskloom.sources.encounters_csv import load_data, load_report, load_table
from riskloom.sources.lookups import ENCOUNTER_LOOKUPS, lookup_frame
from riskloom.sources.sinks import (
    append_scored_batch,
    existing_columns,
    load_model,
    prediction_columns,
    save_comparison_results,
    save_model,
    save_predictions,
    save_test_predictions,
)

__all__ = [
    "ENCOUNTER_LOOKUPS", "append_scored_batch", "existing_columns", "load_data", "load_model",
    "load_report", "load_table", "lookup_frame", "prediction_columns", "save_comparison_results",
    "save_model", "save_predictions", "save_test_predictions",
]
