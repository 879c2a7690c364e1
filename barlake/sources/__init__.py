"""Reading and writing: landed files, layer tables, shared scratch space."""
