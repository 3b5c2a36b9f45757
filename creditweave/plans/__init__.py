"""Operators composed into whole jobs and registered queries."""
