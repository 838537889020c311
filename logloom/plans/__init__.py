"""Reports over the metric tables, and the registry of runnable queries."""
