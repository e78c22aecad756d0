"""Plans: the movement-table sink and the named query catalogue."""
