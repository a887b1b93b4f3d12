"""Readers: grid files, stored tables, zone layers and work manifests."""
