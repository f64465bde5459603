"""framefold: media-enrichment analytics as Spark DataFrame operators."""
