"""Operators for building language-model training corpora; nothing else in the library imports this subpackage."""
