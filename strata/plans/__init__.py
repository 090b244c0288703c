"""Jobs over the layer tables: refresh and purchase propensity."""
