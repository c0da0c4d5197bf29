"""Report sheets, stored tables, seeds and the sample tables."""
