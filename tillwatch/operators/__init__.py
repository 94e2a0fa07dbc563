"""Preparation, metrics, flagging, quality, reporting and export."""
