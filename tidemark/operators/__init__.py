"""operators of the tidemark package."""
