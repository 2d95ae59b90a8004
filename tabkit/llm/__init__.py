"""Training-data operators (packing, dedup, scans, formatting) and their queries.

Nothing else in the library imports this subpackage; ``queries`` holds the
registered ``opN_<name>`` queries and their DuckDB SQL.
"""
