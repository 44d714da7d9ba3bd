"""Report tables, published outputs and the full run."""
