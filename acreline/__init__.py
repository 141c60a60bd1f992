"""Acreline: tabular feature, validation and scoring work written as Spark DataFrame jobs."""
