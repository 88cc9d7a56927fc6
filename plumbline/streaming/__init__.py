"""Stateful operators on streams.  Stateless ones are used on streams as they are."""
