"""The banking model: one module per layer, built from the generic operators."""
