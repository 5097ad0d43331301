"""Column functions: draws, names, vectors, activations."""
