"""Operators for training-data corpora; nothing outside this subpackage imports it."""
