"""Silver and Gold tables, reports, and the daily run that chains them."""
