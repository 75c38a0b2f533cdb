"""fxlake."""
