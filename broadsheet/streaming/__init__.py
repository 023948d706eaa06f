"""The same cleaning and scoring over pages that keep arriving."""
