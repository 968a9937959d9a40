"""Order analytics as Spark jobs: Bronze, Silver, Gold tables and report queries."""
