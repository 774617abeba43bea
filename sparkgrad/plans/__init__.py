"""Whole forward passes, training loops and variant sweeps."""
