"""sources of the tidemark package."""
