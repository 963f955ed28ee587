"""Operators that run on batch and streaming DataFrames alike."""
