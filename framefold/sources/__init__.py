"""Readers and writers of landed documents and derived tables."""
