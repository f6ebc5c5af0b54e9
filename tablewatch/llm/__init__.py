"""Operators for preparing large text and embedding corpora: near-duplicate and passage
removal, quality and toxicity scoring, token counts, decontamination and packing.

Nothing else in the library imports this subpackage."""
