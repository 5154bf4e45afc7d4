"""Sources: topic streams, bronze files, webhook payloads and test tables."""
