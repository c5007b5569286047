"""Readers: log objects, notifications, config items, pod logs."""
