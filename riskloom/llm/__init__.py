"""Operators for training-data corpora at scale; nothing else in the library imports this subpackage."""
