"""Reusable DataFrame steps: latest values, joins, merges, checks and masking."""
