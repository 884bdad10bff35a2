"""Layer builds and the whole pipeline."""
