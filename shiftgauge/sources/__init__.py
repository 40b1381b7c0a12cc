"""Readers for the inputs."""
