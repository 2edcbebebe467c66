"""Training-data operators: chat, personal data, deduplication, mixing, search, language, licences, packing, token files."""
