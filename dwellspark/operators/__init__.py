"""Analytical operators, each a function from DataFrame to DataFrame."""
