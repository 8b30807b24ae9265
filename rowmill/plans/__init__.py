"""Composite plans: fixture views, end-to-end pipeline, throughput, publishing."""
