"""Sources and sinks: Kafka, CSV user log, file replay, parquet/console/JDBC sinks."""
