"""Bronze, silver and gold builds, the lake extracts and the analyst views."""
