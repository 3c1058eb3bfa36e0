"""Parquet sources and sinks: tables, samples, report sections, encoder maps."""

from featurelens.sources.tables import read_table, sample_table_to_path, write_table
from featurelens.sources.reports import load_artefacts, read_report, report_sections, save_artefacts, vacuum, write_report

__all__ = ["read_table", "write_table", "sample_table_to_path", "write_report", "read_report",
           "report_sections", "save_artefacts", "load_artefacts", "vacuum"]
