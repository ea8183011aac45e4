"""Operators with state or rules of their own: upsert, history, dedupe, quality, layout."""
