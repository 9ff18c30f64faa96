"""Support-conversation analytics as Spark DataFrame jobs."""
