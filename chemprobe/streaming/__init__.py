"""Structured Streaming variants of the additive aggregates."""
