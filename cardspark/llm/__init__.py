"""Operators for training-data pipelines: filters, classifiers, duplicate removal, decontamination, mixing."""
