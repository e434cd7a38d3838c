"""Readers that turn raw inputs into the declared source tables."""
