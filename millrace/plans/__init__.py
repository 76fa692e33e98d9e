"""The trip and air-quality marts, observability views and alerts."""
