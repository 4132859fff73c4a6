"""Readers: driver tables, tick tapes, Kafka-shaped records, streams, files."""
