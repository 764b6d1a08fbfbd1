"""Incremental and stateful jobs."""
