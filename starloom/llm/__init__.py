"""Training-data operators: quality, packing, privacy, near duplicates, mixing, token counts,
repeated text and language-model scores. Nothing else in the library imports this package."""
