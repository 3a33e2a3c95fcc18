"""Recipes that chain the operators over a whole delivery."""
