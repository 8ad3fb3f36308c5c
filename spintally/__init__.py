"""Hourly and daily rollups of gaming-session events on Spark."""
