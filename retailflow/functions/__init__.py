"""Column helpers: null rules, SKU grammar, month sets."""
