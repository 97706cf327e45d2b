"""functions of the tidemark package."""
