"""Plans: publishing (versioned segments + manifest), daily jobs, and the registered
queries with their DuckDB oracles."""
