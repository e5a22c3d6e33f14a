"""Reading tables, id lists and metadata blobs."""
