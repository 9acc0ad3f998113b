"""Relational operators over mutation vectors, reads, references and profiles."""
