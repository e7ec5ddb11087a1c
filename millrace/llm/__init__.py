"""Operators for building training data: extraction, tokens, filters, near copies, labels."""
