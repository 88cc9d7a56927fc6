"""Column-level building blocks: JSON values, documents, patterns, hashes."""
