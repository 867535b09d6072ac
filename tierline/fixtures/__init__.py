"""Snapshot tables derived from the star-schema test tables, for tests and checks."""
