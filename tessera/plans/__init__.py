"""Allocation and mixture plans on small tables of cells."""
