"""Published tables, one function each."""
