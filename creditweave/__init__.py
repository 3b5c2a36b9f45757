"""Auditable credit-risk analytics written as Spark DataFrame jobs."""
