"""Scans and sinks: snapshot CSV (S1-S3, S9), category JSON (S4, S5),
report TSV (S8) and the report / stage writers (S6, S7, P10)."""

from vidtrend.sources.snapshots import (
    decode_lines, parse_snapshot_lines, read_snapshot_lines, read_snapshots, union_snapshots,
)
from vidtrend.sources.categories import (
    categories_from_documents, read_categories,
)
from vidtrend.sources.reports import parse_report_lines, read_report, read_report_head
from vidtrend.sources.sinks import (
    read_bucketed_stage, to_tsv_lines, write_bucketed_stage, write_report, write_stage,
)

__all__ = [
    "decode_lines", "parse_snapshot_lines", "read_snapshot_lines", "read_snapshots", "union_snapshots",
    "categories_from_documents", "read_categories",
    "parse_report_lines", "read_report", "read_report_head", "to_tsv_lines", "write_report", "write_stage",
    "read_bucketed_stage", "write_bucketed_stage",
]
