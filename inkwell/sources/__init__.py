"""Readers of the export, the article and account tables, and the source categories."""
