"""Column -> Column expressions; everything but the title similarity is native."""
