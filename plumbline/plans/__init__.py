"""Ready bindings and the end-to-end run."""
