"""Operators on DataFrames: selection, upsert, labelling, datasets, evaluation."""
