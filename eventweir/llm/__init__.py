"""Operators for training-data pipelines: one module per operator, `catalog` for the queries.

Nothing else in the package imports this subpackage.
"""
