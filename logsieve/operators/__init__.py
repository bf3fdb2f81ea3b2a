"""Operators over documents DataFrames."""
