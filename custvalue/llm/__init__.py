"""Operators that prepare text corpora: mixing, tokens, archives, duplicates, filters."""
