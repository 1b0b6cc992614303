"""Sources: JSON feeds (S1-S2), delimited text (S6, S9), literal rows (S8), tables."""
