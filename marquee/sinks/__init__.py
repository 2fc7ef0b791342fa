"""Publishing and physical layout."""
