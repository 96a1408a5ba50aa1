"""Operators for large-scale training-data pipelines.

Each module holds one operator with a general interface, the thin registered
query ``opN_<name>`` over the fixture tables, and its DuckDB SQL where SQL can
express it. Nothing outside this package imports it; ``__spark_entry__``
adds the queries when the package is present.
"""
