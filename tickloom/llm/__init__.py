"""Operators of a training-data pipeline: archives, licences, secrets, packing, extraction, decontamination,
similarity join, address filter, quality rules and token counts."""
