"""Outreach-activity analytics expressed as Spark DataFrame jobs."""
