"""Operators for building training corpora: packing, language ID, de-duplication, decontamination.

One module per operator, plus helpers that several of them share. Nothing outside this
subpackage imports it.
"""
