"""Relational, graph, learning and risk operators on DataFrames."""
