"""Training-data operators: filtering, deduplication, decontamination, scoring, encoding, formatting."""
