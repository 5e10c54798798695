"""Layer pipeline, reports, graph queries and the driver-bound queries."""
