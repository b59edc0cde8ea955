"""Training-data pipeline operators (language ID, near-duplicate joins, exact
substring removal, decontamination, mixing, token counts, archives, ...).

Nothing outside this subpackage imports it.
"""
