"""Whole jobs and named queries composed from the operators."""
