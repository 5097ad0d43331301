"""Whole jobs: training, evaluation, search, the gold tables and the query catalog."""
