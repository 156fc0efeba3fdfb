"""Writers for the lake, documents and relational tables."""
