"""Relational operators over documents, manifests and side tables."""
