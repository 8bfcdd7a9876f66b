"""Whole reads, and the registered queries over the test tables."""
