"""Whole jobs, and the inputs and checks that run them over the test tables."""
