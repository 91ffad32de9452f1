"""Table-level operators: cleaning, validation and the analyses."""
