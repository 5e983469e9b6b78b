"""DataFrame sources: Kafka, message files, CSV, alert JSON, readings from the test tables."""
