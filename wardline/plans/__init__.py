"""Runnable plans over the driver tables: message carriers, registered queries, oracle SQL."""
