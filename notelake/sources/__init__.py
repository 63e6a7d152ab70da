"""Sources: the base tables of notes."""
