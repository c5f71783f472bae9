"""Operators for large training-data pipelines.

Nothing else in the package imports this subpackage.  ``llm.catalog`` lists
the registered queries ``opN_<name>`` and their DuckDB SQL.
"""
