"""Readers and writers: raw lines, typed CSV, month layer, scratch tables."""
