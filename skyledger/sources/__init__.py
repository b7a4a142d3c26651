"""Readers and writers: tables, feed documents, catalog CSV, messages."""
