"""Training-data operators: quality rules, near-duplicates, toxicity, line
duplicates, language-model scores, chat formatting, mixing, packing, media
columns and WARC archives.  Nothing else in the library imports this package."""
