"""User-level operators, each a plain function from DataFrame to DataFrame."""
