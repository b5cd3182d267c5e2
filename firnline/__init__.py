"""Snow-hazard features, training data, scoring and explanation as Spark jobs."""
