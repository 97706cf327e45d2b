"""streaming of the tidemark package."""
