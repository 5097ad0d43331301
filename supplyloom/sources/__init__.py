"""Schemas, tables and landing folders."""
