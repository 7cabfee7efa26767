"""Table contracts, readers, sinks and the model store."""
