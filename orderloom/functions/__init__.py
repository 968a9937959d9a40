"""Column-level building blocks: exact arithmetic and ordered label rules."""
