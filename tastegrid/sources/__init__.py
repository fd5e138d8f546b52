"""Readers, writers and the domain views built on given tables."""
