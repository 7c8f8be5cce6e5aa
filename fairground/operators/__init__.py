"""Joins, merges and state machines over event tables."""
