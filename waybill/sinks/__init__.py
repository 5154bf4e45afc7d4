"""Sinks: bronze, rejects, silver, tables and the webhook store."""
