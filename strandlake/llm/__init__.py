"""Training-data operators: archives, near-duplicates, decontamination, packing and the like.

Nothing outside this subpackage imports it.
"""
