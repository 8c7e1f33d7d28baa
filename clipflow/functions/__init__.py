"""Column expressions: angles, rotations and boxes."""
