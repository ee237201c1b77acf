"""Operators of a training-data pipeline: deduplication, archives, quality, decontamination, tokens, search, secrets, URL lists."""
