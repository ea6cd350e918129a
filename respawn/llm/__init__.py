"""Training-data operators: language ID, HTML extraction, tokenizing, dedup, mixing, archives, secrets."""
