"""Daily drift job (entry C of SURVEY §3):
read prediction logs → D1 mean-shift drift → D6 decision → D7 alert and D8
retrain request, appended (K7) to the reports dataset partitioned by kind.

One aggregation job over the date-pruned logs; the alert and request rows are
projections of its one-row (or one-row-per-group) result, not driver logic.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators import drift
from vigil.sources import readers, sinks


def run_drift_job(spark: SparkSession, log_path: str, reports_path: str, now: _dt.datetime,
                  threshold: float = drift.DRIFT_THRESHOLD, by=(), exclude_failed: bool = True,
                  catalog: str | None = None) -> DataFrame:
    """Returns the decided drift result (also appended as kind ``drift``). Log
    files of the range that cannot be read are reported as ``rejected_logs``."""
    since = now - _dt.timedelta(hours=drift.WINDOW_HOURS) - _dt.timedelta(days=drift.BASELINE_DAYS)
    logs = readers.read_prediction_logs(spark, log_path, since=since, until=now, catalog=catalog)
    result = drift.drift_decision(drift.mean_shift_drift(
        logs, now, threshold=threshold, by=by, exclude_failed=exclude_failed)).cache()
    try:
        stamp = now.replace(tzinfo=_dt.timezone.utc)
        # Alert and request are projections that keep the drifted rows only.
        sinks.append_report(result, reports_path, "drift", at=stamp)
        sinks.append_report(drift.drift_alert(result), reports_path, "drift_alert", at=stamp)
        sinks.append_report(drift.retrain_request(result, stamp.isoformat()), reports_path, "retrain_request", at=stamp)
        sinks.append_report(readers.rejected_log_files(spark, log_path, since, now, catalog=catalog),
                            reports_path, "rejected_logs", at=stamp)
        return result.select(*result.columns)
    finally:
        result.unpersist()
