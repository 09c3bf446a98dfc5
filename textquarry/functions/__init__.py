"""Column functions: normalisers, shingles, risk patterns, hashes."""
