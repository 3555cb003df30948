"""Reading and writing company tables and the landed lookup tables."""
