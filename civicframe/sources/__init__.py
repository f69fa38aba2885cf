"""From pages and documents to rows, and from rows to files."""
