"""Training-data operators: dedup, language, secrets, tokens, quality, mixing."""
