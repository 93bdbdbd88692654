"""Whole queries: the analytical marts and the processing run."""
