"""Streaming forms: folds over micro-batches, query starts and triggers."""
