"""Operators for preparing training data at scale. Nothing outside uses them."""
