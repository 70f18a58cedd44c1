"""Operators of a training-data pipeline: filtering, deduplication, mixing, packing, files.

Nothing outside this folder imports it.  Conventions of all operators: ``docs`` has an
integer ``doc_id`` and a string ``text``; other columns pass through or are ignored; a
null text counts as empty; each input row is handled for itself, so repeated rows give
repeated results; an empty table gives an empty result.
"""
