"""Commerce-event analytics on Spark: raw click-stream events to clean, aggregated and served tables."""
