"""Readers, writers and dataset identity."""
