"""Readers of message streams, staged files, silver files and agreements."""
