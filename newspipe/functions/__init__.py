"""Column-level building blocks: HTML text, URLs, cell values."""
