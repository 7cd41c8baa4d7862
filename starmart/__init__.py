"""Star-schema analytics on Spark: raw order tables in, checked star tables out."""
