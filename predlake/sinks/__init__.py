"""Destinations (U3): registered by type in :mod:`predlake.plans.logger`."""
