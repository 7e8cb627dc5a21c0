"""Operators for preparing the texts that language models are trained on."""
