"""Silver and Gold models, checks and measures."""
