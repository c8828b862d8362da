"""Declarative feed plans: validated rule sets and the end-to-end feed run."""
