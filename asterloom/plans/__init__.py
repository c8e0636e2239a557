"""Configurations and whole runs built from the operators."""
