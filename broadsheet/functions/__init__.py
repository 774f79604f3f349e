"""Column-level building blocks, all native Spark expressions."""
