"""plans of the tidemark package."""
