"""Readers and writers: landed cell matrices, lake tables, versioned state."""
