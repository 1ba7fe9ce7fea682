"""Incremental twins of batch operators; their tables equal the batch results."""
