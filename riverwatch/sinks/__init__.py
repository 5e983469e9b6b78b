"""Batch writers for messages and views."""
