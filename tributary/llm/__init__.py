"""Training-data operators: dedup, language-model scores, licences, personal data, packing, chat, quality."""
