"""Reusable plan shapes: tiled ordered scans, salted joins and the end-to-end pipelines."""
