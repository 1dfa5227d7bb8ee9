"""HTML documents as ordered arrays of nodes."""
