"""Structured Streaming hops between the layers."""
