"""Whole jobs: contracts, cleaners, gates, publication, conversion and trajectory builds."""
