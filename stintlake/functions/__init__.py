"""Column expressions and the ordered-group helpers the operators share."""
