"""Writers of the published layout."""
