"""Reading tables and incremental slices; writing tables."""
