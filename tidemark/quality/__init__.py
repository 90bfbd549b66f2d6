"""Data-quality checks in fused passes."""
