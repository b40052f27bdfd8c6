"""Parametric reports and jobs, registered as named queries with their SQL
oracles (see ``registry``)."""
