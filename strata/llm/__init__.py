"""Training-data operators: deduplication, archives, extraction, scoring, tokens, shards.

Nothing else in the library imports this subpackage; ``registry`` holds the
registered queries and their DuckDB SQL.
"""
