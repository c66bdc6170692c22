"""Profiling, binary classification and ensembling of labelled tables on Spark."""
