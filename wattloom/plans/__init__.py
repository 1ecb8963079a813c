"""The model graph and its runner."""
