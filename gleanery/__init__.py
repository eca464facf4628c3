"""Collected-document analytics on Spark: flatten, clean, match, keep history, report."""
