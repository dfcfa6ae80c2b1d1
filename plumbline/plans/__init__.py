"""Models, report queries and the daily run, composed from the operators."""
