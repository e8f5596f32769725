"""Relational, statistical and model operators; DataFrames in, DataFrames out."""
