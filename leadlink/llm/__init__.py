"""Operators for building language-model training data, each with a registered query."""
