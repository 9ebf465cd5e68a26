"""Inputs: fact tables on storage, the block feed, and the events-derived fixtures."""
