"""Where logs come from (Kafka, replayed files) and how landed tables are read."""
