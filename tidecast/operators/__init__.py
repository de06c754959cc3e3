"""DataFrame -> DataFrame operators (models: DataFrame -> fitted pipeline)."""
