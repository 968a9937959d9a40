"""Reading source tables, loading Bronze, and the layered tables of the lake."""
