"""Readers and writers of tab-separated files and identifier lists."""
