"""Training-data operators: filtering, near-duplicate search, decontamination, scoring and mixing."""
