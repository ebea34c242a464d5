"""Corpus operators for training data; nothing outside this folder imports it."""
