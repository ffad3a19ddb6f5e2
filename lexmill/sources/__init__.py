"""Readers and writers for document artifacts, lookups and state tables."""
