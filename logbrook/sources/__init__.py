"""Inputs and stored tables."""
