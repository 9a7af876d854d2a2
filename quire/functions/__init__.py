"""Column functions: normalisation, classification, token prices, stable hashes."""
