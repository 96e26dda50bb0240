"""Operations on training data: near duplicates, language, packing, mixing, secrets, quality, token files."""
