"""Wrenfield: event-curation analytics as Spark DataFrame jobs."""
