"""Spark jobs over public disclosure registers: discovery, matching, reconciliation, feeds, history, link graphs."""
