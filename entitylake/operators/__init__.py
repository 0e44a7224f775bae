"""Relational operators over entity frames."""
