"""Customer-event analytics on Spark: features, quality rules, streams, attrition scores."""
