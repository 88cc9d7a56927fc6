"""Readers of events, schemas and specifications; writers of request bodies."""
