"""The jobs: from raw tables to marts and reports."""
