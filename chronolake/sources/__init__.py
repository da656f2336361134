"""Where change records come from: Kafka, files, table snapshots."""
