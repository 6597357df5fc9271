"""Outputs: key-value serving rows, lake archive, exports."""
