"""Operators over keyed tables and plain frames."""
