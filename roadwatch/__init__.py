"""Roadside sightings analytics: speed violations from camera streams, on Spark."""
