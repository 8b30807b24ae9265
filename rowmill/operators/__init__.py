"""DataFrame -> DataFrame operators."""

from rowmill.operators.aggregate import aggregate, metric, parse_metrics, top_k
from rowmill.operators.dedup import dedup, dedup_by_join, detect_keys
from rowmill.operators.limit import take_any, take_ordered
from rowmill.operators.profile import profile
from rowmill.operators.quality import (
    QualitySpec,
    duplicate_groups,
    failing,
    parse_thresholds,
    quality_report,
    quality_summary,
    report_to_dict,
)
from rowmill.operators.quality_state import QualityStore, check_state, merge_states, report_from_state
from rowmill.operators.quantile import percentile_disc, percentile_from_counts
from rowmill.operators.reports import REPORTS, reports_one_pass, run_report, run_reports, segment_state
from rowmill.operators.sketch import merge_sketches, quantile_of, quantile_sketches, rank_errors
from rowmill.operators.route import PRESET_BASIC, RULE_SETS, Rule, apply_rule_set, route
from rowmill.operators.validate import (
    ValidationSpec,
    annotate,
    error_counts,
    invalid_sample,
    normalize_zip,
    split,
    validation_counts,
    zip_changes,
)

__all__ = [
    "aggregate", "metric", "parse_metrics", "top_k",
    "dedup", "dedup_by_join", "detect_keys",
    "profile", "take_any", "take_ordered",
    "QualitySpec", "duplicate_groups", "failing", "parse_thresholds", "quality_report", "quality_summary",
    "report_to_dict", "percentile_disc", "percentile_from_counts",
    "QualityStore", "check_state", "merge_states", "report_from_state",
    "merge_sketches", "quantile_of", "quantile_sketches", "rank_errors",
    "REPORTS", "reports_one_pass", "run_report", "run_reports", "segment_state",
    "PRESET_BASIC", "RULE_SETS", "Rule", "apply_rule_set", "route",
    "ValidationSpec", "annotate", "error_counts", "invalid_sample", "normalize_zip", "split",
    "validation_counts", "zip_changes",
]
