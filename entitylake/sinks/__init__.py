"""Sinks: staged entity files, log / latest tables, entity feeds."""
