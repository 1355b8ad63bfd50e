"""Readers of file trees, front-matter, indexes, logs and caches, and the matching writers."""
