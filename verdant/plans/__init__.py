"""Plans over the operators: the query surface, gates, publish and build."""
