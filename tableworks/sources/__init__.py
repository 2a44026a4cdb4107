"""Reading and writing stored tables, and parsing raw text, archives and JSON."""
