"""Column functions: geometry, colour, and numbered sequences."""
