"""Composed plans: stand-in adapters, marts, the cold-path pipeline and the query registry."""
