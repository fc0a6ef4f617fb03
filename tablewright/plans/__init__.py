"""Whole tasks, composed of the operators: comments, risk and income."""
