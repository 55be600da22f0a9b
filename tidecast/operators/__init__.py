"""DataFrame -> DataFrame operators on the daily panel."""
