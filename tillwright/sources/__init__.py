"""Readers, generated sequences, writers, and the retail tables derived from the test data."""
