"""Operators of a training-data pipeline over `documents`, `pages` and `embeddings`.

Each module holds one operator with a general interface; ``queries`` derives the
registered queries from them and ``oracle`` holds the DuckDB SQL where SQL can
express a result. Nothing else in the package imports this subpackage.
"""
