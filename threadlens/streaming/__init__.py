"""Structured Streaming jobs of the live products.

Sources are Kafka-shaped records (offset, timestamp, value).  A Kafka topic is
read with ``kafka_source``; tests and replays land the same records as Parquet
files and read them with ``file_source``.  Every job runs with a checkpoint
under the session's ``spark.checkpoint.dir`` and writes idempotently, so a
lost executor or a restarted driver replays a batch without double counting.
"""
