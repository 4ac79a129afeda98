"""Ready-made pipelines composed of the operators."""
