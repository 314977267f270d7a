"""Operators for large-scale training-data preparation.

Nothing outside this subpackage imports it; `entry` holds its registered
queries and oracles.
"""
