"""Reports over case rows."""
