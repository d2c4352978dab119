"""Whole pipelines, and the queries by which they are checked."""
