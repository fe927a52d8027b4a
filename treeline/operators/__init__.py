"""Relational operators on snapshots, indexes, stories and releases."""
