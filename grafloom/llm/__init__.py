"""Operators for preparing language-model training data; nothing else in grafloom imports them."""
