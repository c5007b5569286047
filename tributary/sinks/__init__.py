"""Writers: central objects, object copies, batch and metric tables."""
