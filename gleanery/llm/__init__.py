"""Operators for building training data from documents and embeddings; see ``queries`` for their use."""
