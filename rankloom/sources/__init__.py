from rankloom.sources.readers import (
    RESULTS_SCHEMA, attach_target, read_adjacency, read_metafeatures, read_results, read_score_reports,
    read_wide_rankings,
)
from rankloom.sources.writers import write_predictions, write_value_counts

__all__ = [
    "RESULTS_SCHEMA", "attach_target", "read_adjacency", "read_metafeatures", "read_results", "read_score_reports",
    "read_wide_rankings", "write_predictions", "write_value_counts",
]
