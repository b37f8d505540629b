"""Writers: raw tables and ordered text blocks."""
