"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage.  Each module holds one
operator; ``queries`` registers one query per operator over the benchmark
tables.  Every operator takes DataFrames and returns DataFrames, works on whole
texts and whole tables, and keeps per-task memory bounded by its partition.
"""
