"""Inputs for the registered queries, derived from the generic test tables."""
