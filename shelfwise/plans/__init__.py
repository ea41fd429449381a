"""Plans: analyst questions, the layer runner and the query registry."""
