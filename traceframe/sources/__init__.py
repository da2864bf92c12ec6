"""Readers and writers of the table layers."""
