"""Flood-risk and postcode analytics as Spark jobs."""
