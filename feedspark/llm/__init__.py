"""Operations of a training-data pipeline: dedup, language, packing, token files and more."""
