"""Readers and writers of the three layers."""
