"""Operators for preparing training text at scale.

Nothing else in the library imports this subpackage. Every operator takes and returns DataFrames;
``queries`` registers one production query for each of them.
"""
