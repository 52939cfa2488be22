"""Report plans, one module per family."""
