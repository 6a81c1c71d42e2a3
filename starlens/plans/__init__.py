"""Registered queries (catalog), their oracle SQL, and plan inspection helpers."""
