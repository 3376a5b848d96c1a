"""Curation of multi-modal episode datasets as DataFrame-in, DataFrame-out operators on Spark."""
