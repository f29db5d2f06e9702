"""Readers: daily files, the landing table, stored tables."""
