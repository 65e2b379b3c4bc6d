"""Outage and weather analytics as plain ``DataFrame -> DataFrame`` operators."""
