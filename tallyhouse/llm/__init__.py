"""Training-data operators: extraction, deduplication, packing, language and
quality models, mixing. Nothing else in the package imports this folder."""
