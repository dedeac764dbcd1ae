"""Jobs that chain operators: load, refresh, daily run."""
