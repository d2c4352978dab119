"""Steps from registry and position tables to trajectories, DataFrame in and DataFrame out."""
