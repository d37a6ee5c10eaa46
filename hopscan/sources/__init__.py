"""Readers and writers. All reading stays lazy and splits by Spark's file sources."""
