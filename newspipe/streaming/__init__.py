"""Running the same operators on streams."""
