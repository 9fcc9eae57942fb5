"""Plans over the analyses: registry runner, result views, test projections."""
