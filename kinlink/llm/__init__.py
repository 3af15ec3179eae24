"""Operators for preparing training text at corpus scale.

Every operator takes DataFrames and column names, selects only the columns it
needs (so other columns of any name are ignored) and returns a DataFrame.
Nothing else in the library imports this subpackage.
"""
