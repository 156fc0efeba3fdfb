"""Flows that chain operators, the model registry and the registered queries."""
