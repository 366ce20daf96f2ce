"""Column functions: water physics, solar geometry, scores, keys."""
