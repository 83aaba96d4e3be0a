"""Operators: DataFrame in, DataFrame out. None of them runs a job unless its docstring says so."""
