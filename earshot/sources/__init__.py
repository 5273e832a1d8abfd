"""Readers, tables and writers."""
