"""Readers, writers and side outputs."""
