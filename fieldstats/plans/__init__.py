"""The data products: each builder maps source tables to one result frame.

Source tables come as a mapping from short name to DataFrame (FIXTURES.md, part A).
"""
