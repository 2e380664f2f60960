"""The same data as streams."""
