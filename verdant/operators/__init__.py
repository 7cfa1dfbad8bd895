"""DataFrame -> DataFrame operators of the catalogue build."""
