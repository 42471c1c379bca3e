"""Frame-level operators: profile, clean, deduplicate, fill, look up, gate."""
