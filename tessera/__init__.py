"""Turns heterogeneous raw payloads into typed, deduplicated and entity-resolved tables, as Spark plans."""
