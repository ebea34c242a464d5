"""Phonetic name linkage as Spark jobs."""
