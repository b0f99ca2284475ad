"""Queries over the TPC-H-like test tables: adapter to the source shapes, queries and oracles."""
