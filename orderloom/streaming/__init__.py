"""File-stream form of the incremental Bronze load."""
