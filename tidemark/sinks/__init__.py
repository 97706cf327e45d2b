"""sinks of the tidemark package."""
