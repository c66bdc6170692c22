"""Readers and writers: CSV, score tables, saved models and the run log."""
