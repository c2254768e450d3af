"""Readers, writers, generators and the mapping of the shared test tables."""
