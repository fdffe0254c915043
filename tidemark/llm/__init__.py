"""Operators for training-data corpora: text, embeddings and web pages."""
