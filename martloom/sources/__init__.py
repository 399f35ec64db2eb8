"""Reading raw inputs and writing tables."""
