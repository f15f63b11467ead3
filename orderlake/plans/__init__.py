"""Runnable plans: the two batch pipelines and the query catalog."""
