"""Column functions: Catalyst expressions only, usable in batch and streaming plans."""
