"""Station-weather event analytics as Spark jobs."""
