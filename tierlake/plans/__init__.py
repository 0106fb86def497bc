"""Plans: the race-shaped fixture, landing files, the pipeline and the query registry."""
