"""Operators for preparing text corpora; see queries.py for the registered queries."""
