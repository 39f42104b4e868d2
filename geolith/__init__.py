"""geolith: gridded terrain, land-cover and map-feature analytics on Spark."""
