"""The four collections, from landed documents to stored tables and reports."""
