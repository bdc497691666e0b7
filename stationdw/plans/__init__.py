"""Composed jobs: star load, views, reports, catalog, end-to-end steps, driver mapping."""
