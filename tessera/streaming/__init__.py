"""Structured Streaming: the self-refreshing daily aggregate (SNK4)."""
