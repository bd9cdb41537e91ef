"""Whole jobs: ingestion runs, the analysis report, and the registered queries."""
