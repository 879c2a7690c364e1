"""Table-to-table operators, one module per layer or concern."""
