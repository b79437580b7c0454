"""Whole jobs: incremental refresh, exports, and the query catalogue."""
