"""Operators for preparing training data: ten operators, their queries, and the stages built of them."""
