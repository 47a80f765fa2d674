"""Reading and writing tables, file selection, page links."""
