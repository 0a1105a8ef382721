"""Operators for language-model training data.  Optional: nothing outside this subpackage imports it."""
