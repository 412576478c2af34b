"""Whole flows and the inputs they run on."""
