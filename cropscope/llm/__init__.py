"""Training-data operators: packing, near duplicates, decontamination, line
dedup, language modelling, token attribution, text classifiers and rules.

Nothing else in the library imports this subpackage.
"""
