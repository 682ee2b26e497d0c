"""Readers: the message topic, its file double, bronze days, event fixtures."""
