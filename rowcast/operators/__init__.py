"""Reports and transformations, one module per subject."""
