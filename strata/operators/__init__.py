"""DataFrame -> DataFrame operators of the three layers, exploration and scoring."""
