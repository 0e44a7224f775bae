"""Sources: tables read as rows or entities, entity-batch payloads, staged files."""
