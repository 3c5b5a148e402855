"""Column helpers: cleaning, exact numerics, dates, keyword tagging, banding."""
