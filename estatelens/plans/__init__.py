"""Job catalogue, mart build and oracle texts."""
