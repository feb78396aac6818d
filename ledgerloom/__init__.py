"""Ledger reconciliation on Spark: readers, cleaning, staged matching passes and reports."""
