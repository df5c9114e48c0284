"""Models and reports made of several operators."""
