"""Relational operators: reshape, init, layers, losses, gradients, updates, reports."""
