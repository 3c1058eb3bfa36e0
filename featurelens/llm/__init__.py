"""Operations of a training-data pipeline: extraction, near-duplicates,
decontamination, scoring, licences, mixing, quality, personal data.

Nothing else in the library imports this subpackage.
"""
