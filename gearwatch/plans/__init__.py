"""Whole pipelines composed from the operators (fused or staged through topics)."""
