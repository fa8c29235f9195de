"""Reading and writing: event landing, published tables, test-table adapter."""
