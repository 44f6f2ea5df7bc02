"""Wiring: the layers as one graph of lazy tables, materialization, and the query registry."""
