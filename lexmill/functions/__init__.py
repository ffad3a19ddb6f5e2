"""Column functions: everything here is row-local and needs no shuffle."""
