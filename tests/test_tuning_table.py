"""The table of tuning results, from made-up scores."""

import json

from tablewright.operators import selection


def test_gains_and_left_out_columns(spark):
    held = {"F1_weighted": 0.91, "Recall_failure": 0.5}
    entries = [
        {"model": "m", "best_params": {"k": 3}, "cv_before": 0.9, "cv_after": 0.9 + 1e-7, "before": held, "after": {**held, "F1_weighted": 0.9, "ROC_AUC": 0.75}},
        {"model": "n", "best_params": {}, "cv_before": 0.8, "cv_after": 0.7, "before": held, "after": {**held, "ROC_AUC": 0.5}},
    ]
    table = selection.tuning_table(spark, entries, selection.F1W)
    first, second = (r.asDict() for r in table.collect())
    assert json.loads(first["best_params"]) == {"k": 3}
    assert first["CV_delta"] == 0.0 and first["improved_on_CV"]  # the verdict is not rounded
    assert (first["HeldOut_delta"], second["CV_delta"], second["improved_on_CV"]) == (-0.01, -0.1, False)
    assert first["HeldOut_ROC_AUC_after"] == 0.75 and "HeldOut_ROC_AUC_before" not in first
    assert first["HeldOut_Recall_failure_before"] == 0.5
