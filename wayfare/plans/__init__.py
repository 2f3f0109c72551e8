"""Query plans: the registered query catalog, SQL oracles and batch jobs."""
