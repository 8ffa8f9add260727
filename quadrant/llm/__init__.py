"""Operators of a large-scale training-data pipeline (documents, pages, embeddings).

Nothing else in the package imports this subpackage. Each operator module holds
a general DataFrame -> DataFrame operator; `queries.py` registers the thin
`opN_<name>` queries over the given tables and `oracles.py` their DuckDB SQL.
"""
