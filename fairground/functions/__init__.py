"""Column functions: text, dates, scores, URLs."""
