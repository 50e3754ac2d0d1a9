"""Part of matchspark."""
