"""Readers, record schemas and the Kafka record format."""
