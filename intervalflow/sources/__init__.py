"""Readers: range scans over the lake, landed JSON pages and documents."""
