"""Readers, writers and the table layouts they use."""

from tablewright.sources.layouts import CENSUS, COMMENTS, HEART
from tablewright.sources.readers import (
    quarantine,
    read_metrics,
    read_results,
    scan_by_uri,
    scan_csv_header,
    scan_csv_headerless,
    scan_csv_text,
)
from tablewright.sources.writers import (
    write_bucketed,
    write_coefficients,
    write_confusion,
    write_metrics,
    write_predictions,
    write_report,
)

__all__ = [
    "CENSUS",
    "COMMENTS",
    "HEART",
    "quarantine",
    "read_metrics",
    "read_results",
    "scan_by_uri",
    "scan_csv_header",
    "scan_csv_headerless",
    "scan_csv_text",
    "write_bucketed",
    "write_coefficients",
    "write_confusion",
    "write_metrics",
    "write_predictions",
    "write_report",
]
