"""Readers and writers. Operators take DataFrames, so only this layer knows paths."""
