"""Where records come from."""
