"""Reliability and failure-risk analytics on event logs, expressed as Spark DataFrame jobs."""
