"""Scans, manifests and partitioned layers."""
