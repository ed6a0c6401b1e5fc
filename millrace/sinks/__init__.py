"""Writers and renderers."""
