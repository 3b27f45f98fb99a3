"""Training-data operators: de-duplication, search, filtering, mixing, tokens, archives and personal data."""
