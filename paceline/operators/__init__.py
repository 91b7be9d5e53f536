"""Operators over DataFrames, written so that no single key has to fit into one task."""
