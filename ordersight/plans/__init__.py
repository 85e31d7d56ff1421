"""Composite plans: the batch job and the dashboard, built from operators."""
