"""Entity-level risk scoring on Spark: prepare, split, train, compare, score, evaluate.

The functions of the batch workflow can be imported from here; the rest lives in
the subpackages.
"""

from riskloom.operators.comparison import compare_models, create_evaluators, evaluate_model, select_best_model
from riskloom.operators.confusion import analyze_confusion_matrix, calculate_confusion_matrix, threshold_sweep
from riskloom.operators.curves import curve_areas, pr_points, roc_points
from riskloom.operators.scoring import filter_high_risk_patients, get_prediction_summary, make_predictions
from riskloom.operators.split import (
    add_sample_weights,
    calculate_class_weights,
    prepare_train_test_split,
    validate_data_leakage_prevention,
)
from riskloom.operators.training import create_feature_pipeline, train_all_models
from riskloom.plans.chart_tables import chart_tables
from riskloom.plans.evaluation import evaluate_and_compare, run_comprehensive_tests
from riskloom.plans.preparation import prepare_encounters, preprocess_data
from riskloom.plans.scoring import predict_pipeline, scoring_reports
from riskloom.plans.training_run import main, train_and_select
from riskloom.sources import load_data, load_model, save_comparison_results, save_model, save_predictions

__version__ = "0.1.0"

__all__ = [
    "add_sample_weights", "analyze_confusion_matrix", "calculate_class_weights", "calculate_confusion_matrix",
    "chart_tables", "compare_models", "create_evaluators", "create_feature_pipeline", "curve_areas",
    "evaluate_and_compare", "evaluate_model", "filter_high_risk_patients", "get_prediction_summary", "load_data",
    "load_model", "main", "make_predictions", "pr_points", "predict_pipeline", "prepare_encounters",
    "prepare_train_test_split", "preprocess_data", "roc_points", "run_comprehensive_tests",
    "save_comparison_results", "save_model", "save_predictions", "scoring_reports", "select_best_model",
    "threshold_sweep", "train_all_models", "train_and_select", "validate_data_leakage_prevention",
]
