"""Reading and writing: extracts, landing files, tables, versioned dimensions, scratch space."""
