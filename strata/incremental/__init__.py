"""Batch-by-batch maintenance of the cleaned and aggregated layers."""
