"""Training-data operators: decontamination, pseudonyms, language mixture,
substring / line / near-duplicate removal, licence notices, nearest
neighbours, packing and toxicity scoring."""
