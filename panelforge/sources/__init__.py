"""Readers, writers and the logical tables of the panel model."""
