"""Operations of a training-data pipeline: licences, tokens, quality, pages, vectors, duplicates, shards, packs."""
