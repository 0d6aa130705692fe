"""Readers, derived input views, load window/registry and snapshot publishing."""
