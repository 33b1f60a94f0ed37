"""Training-data operators: privacy, duplicates, contamination, quality, tokens, licences, secrets."""
