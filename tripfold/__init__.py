"""Trip-event analytics on Spark: start/end events in, daily fare KPIs out."""
