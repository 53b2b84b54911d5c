"""Column functions: text forms, counts, references and rules on single rows."""
