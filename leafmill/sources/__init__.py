"""Readers and writers of messages, content and tables."""
