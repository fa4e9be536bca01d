"""Relational operators of the toll-entry models, one module per layer."""
