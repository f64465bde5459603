"""DataFrame operators: ranking, joins, aggregates, sets, detections, history."""
