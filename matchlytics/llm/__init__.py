"""Operators for preparing language-model training data: DataFrames in, DataFrames out."""
