"""Whole-batch plans: one table per event, or many events into one table."""
