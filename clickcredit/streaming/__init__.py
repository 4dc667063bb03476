"""Structured Streaming: one report per arriving hit file."""
