"""Part of annoforge."""
