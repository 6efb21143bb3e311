"""Part of cellweave."""
