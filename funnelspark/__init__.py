"""Outreach-funnel analytics as Spark jobs: clean, conform, load, aggregate, score."""
