"""Join strategies and multi-table stages."""
