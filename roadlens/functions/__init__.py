"""Part of roadlens."""
