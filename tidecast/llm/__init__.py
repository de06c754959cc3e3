"""Training-data operators: near-duplicates, language-model scoring, licence scans,
quality classification, personal-data pseudonyms, page extraction, BPE, benchmark
decontamination and chat formatting. Nothing else in the library imports this package.
"""
