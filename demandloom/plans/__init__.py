"""The three end-to-end runs, from raw files to diagnosis."""
