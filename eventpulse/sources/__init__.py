"""Readers and writers of daily files, archives and tables."""
