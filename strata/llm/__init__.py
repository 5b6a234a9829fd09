"""Operators for large-scale training-data preparation.

Nothing else in the library imports this subpackage; it borrows only general
helpers (scratch paths) from it. Every operator takes and returns DataFrames.
Columns an operator does not need are dropped before its first shuffle, so
extra columns, whatever their names, cannot clash with its own.
"""
